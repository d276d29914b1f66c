"""Which texts contain any of many answers: an index of anchors instead of every text with every answer.

Each answer stands under one anchor, that of its grams (runs of GRAM characters)
which the fewest texts hold. A text looks up its own distinct grams; those that
are anchors lead to the few answers that it may contain, and these are looked
for. A text meets an answer only through the answer's rarest part, so the work
follows what is found, and no group of rows is named by the question alone.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import staged

#: Characters in a gram; an answer of fewer is its own anchor.
GRAM = 3
#: Bits of the filter that says which grams may be anchors, and different grams that a task counts before it hands them on.
BITS, HELD = 1 << 20, 1 << 18


def grams(text: str, shorter: frozenset[int] = frozenset()) -> set[str]:
    """The distinct grams of a text, and its runs of the shorter lengths."""
    found = {text[i : i + GRAM] for i in range(len(text) - GRAM + 1)}
    for n in shorter:
        found |= {text[i : i + n] for i in range(len(text) - n + 1)} if n else {""}
    return found


def _bit(by: str, gram: str) -> int:
    return zlib.crc32(gram.encode("utf-8", "surrogatepass"), zlib.crc32(by.encode("utf-8", "surrogatepass"))) & (BITS - 1)


def _counts(texts: DataFrame, shorter: frozenset[int]) -> DataFrame:
    """(gram, n): how many texts hold each gram."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(grams(text, shorter))
                if len(held) > HELD:
                    yield rows(held)
                    held.clear()
        if held:
            yield rows(held)

    def rows(held: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["gram", "n"])

    return texts.select("text").mapInArrow(count, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def _answer_grams(answers: DataFrame) -> DataFrame:
    """(by, answer, gram): every gram of each answer, or the answer itself if it is shorter than one."""
    at = F.sequence(F.lit(1), F.greatest(F.length("answer") - GRAM + 1, F.lit(1)))
    return answers.select("by", "answer", F.explode(F.array_distinct(F.transform(at, lambda i: F.substring("answer", i, F.lit(GRAM))))).alias("gram"))


def _filter(anchors: DataFrame) -> tuple[bytes, frozenset[int]]:
    """A bit for each anchor, whatever their number, and the lengths below GRAM that anchors have."""

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {_bit(by, gram) for batch in batches for by, gram in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())}
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], names=["bit"])

    bits = bytearray(BITS // 8)
    for (bit,) in anchors.select("by", "gram").mapInArrow(set_bits, "bit bigint").distinct().collect():  # BITS rows at most
        bits[bit >> 3] |= 1 << (bit & 7)
    return bytes(bits), _shorter(anchors.select(F.col("gram").alias("answer")))


def _shorter(answers: DataFrame) -> frozenset[int]:
    return frozenset(r[0] for r in answers.where(F.length("answer") < GRAM).select(F.length("answer")).distinct().collect())  # GRAM rows at most


def containing(texts: DataFrame, answers: DataFrame) -> DataFrame:
    """(row, by, answer): which of the answers with the same `by` each text contains.

    texts: (row, by, text), row unique; answers: (by, answer). Null texts and answers contain and are nothing; an empty answer is
    in every text. Repeated answers count once; empty tables give no rows. Both are read several times: see staging.
    """
    texts = texts.select("row", "by", "text").where("text is not null and by is not null")
    answers = answers.select("by", "answer").where("answer is not null and by is not null").distinct()
    # of an answer's grams the one in the fewest texts; a gram that is in no text leaves its answer out
    known = _answer_grams(answers).join(_counts(texts.select("text").distinct(), _shorter(answers)), "gram", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    anchors = staged(known.groupBy("by", "answer").agg(F.min(F.struct("n", "gram")).alias("a")).where("a.n > 0").select("by", "answer", F.col("a.gram").alias("gram")), "anchors")
    bits, shorter = _filter(anchors)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for k, (by, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                start = zlib.crc32(by.encode("utf-8", "surrogatepass"))
                for gram in grams(text, shorter):
                    bit = zlib.crc32(gram.encode("utf-8", "surrogatepass"), start) & (BITS - 1)
                    if bits[bit >> 3] >> (bit & 7) & 1:
                        at.append(k)
                        found.append(gram)
            if at:
                yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(at, pa.int64())) for c in (0, 1)], pa.array(found, pa.string())], names=["row", "by", "gram"])

    row = texts.schema["row"].dataType.simpleString()
    met = texts.mapInArrow(look_up, f"row {row}, by string, gram string").join(anchors, ["by", "gram"]).select("row", "answer")
    # a text moves once, whatever the number of answers that it may contain
    return met.join(texts, "row").where(F.contains("text", F.col("answer"))).select("row", "by", "answer")


def least_answers(answers: DataFrame) -> DataFrame:
    """(by, answer) without those answers that contain another one of the same `by`: a text that contains any answer contains
    one of these."""
    answers = answers.select("by", "answer").where("answer is not null and by is not null").distinct()
    named = answers.select(F.struct("by", "answer").alias("row"), "by", F.col("answer").alias("text"))
    more = containing(named, answers).where("row.answer <> answer").select("row.by", "row.answer").distinct()
    return staged(answers.join(more, ["by", "answer"], "left_anti"), "answers")


def any_contained(texts: DataFrame, answers: DataFrame) -> DataFrame:
    """(row): the texts that contain any of the answers with the same `by`; see containing()."""
    return containing(texts, least_answers(answers)).select("row").distinct()
