"""Where answers are: offsets of characters, words and glyphs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_pattern(part: Column) -> Column:
    """A regular expression that matches a text as it is; the text may hold the end of a quotation."""
    return F.concat(F.lit("\\Q"), F.replace(part, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def find_all(text: Column, part: Column) -> Column:
    """Offsets of all occurrences of part in text that do not overlap, from 0; none for an empty part."""
    none = F.array().cast("array<int>")
    once = lambda value, use: F.transform(F.array(value), use)[0]  # noqa: E731  however often use() names the value

    def sums(sizes: Column, start: Column | int, before: bool) -> Column:
        """Running sums from a start, each before or behind its size. A list is copied for each sum, so it has to be short."""
        start = F.struct((F.lit(start) if isinstance(start, int) else start).alias("sum"), none.alias("found"))
        step = lambda acc, n: F.struct((acc["sum"] + n).alias("sum"), F.concat(acc["found"], F.array(acc["sum"] if before else acc["sum"] + n)).alias("found"))
        return F.aggregate(sizes, start, step, lambda acc: acc["found"])

    def blocks(sizes: Column) -> Column:
        """As many blocks as a block is long, so that no list is longer than the root of all."""
        many = F.size(sizes)
        wide = F.greatest(F.ceil(F.sqrt(many)).cast("int"), F.lit(1))
        return once(wide, lambda w: F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(many / w).cast("int") - 1, F.lit(0))), lambda k: F.slice(sizes, k * w + 1, w)))

    def behind(parts: Column) -> Column:
        total = F.transform(parts, lambda b: F.aggregate(b, F.lit(0), lambda acc, n: acc + n))
        return once(sums(total, 0, True), lambda begins: F.flatten(F.transform(parts, lambda b, k: sums(b, F.get(begins, k), False))))

    pieces = F.split(text, literal_pattern(part), -1)
    sizes = once(pieces, lambda p: F.transform(F.slice(p, F.lit(1), F.size(p) - 1), lambda x: F.length(x) + F.length(part)))  # nothing stands behind the last piece
    walked = once(sizes, lambda n: F.transform(once(blocks(n), behind), lambda end: end - F.length(part)))
    return F.when(F.length(part) > 0, walked).otherwise(none)


def answer_offsets(answer: Column, paragraph: Column) -> Column:
    """All offsets of an answer in a paragraph, ascending. A numeric answer does not count inside a longer number on both sides."""
    at = lambda i: F.substr(paragraph, i + 1, F.lit(1))
    free = lambda i: ((i > 0) & F.rlike(at(i - 1), F.lit("[^0-9]"))) | F.rlike(at(i + F.length(answer)), F.lit("[^0-9]"))
    found = find_all(paragraph, answer)
    return F.when(F.rlike(answer, F.lit(r"^\p{N}+$")), F.filter(found, free)).otherwise(found)


def shifted_from_start(offsets: Column, paragraph: Column) -> Column:
    """(offsets, paragraph) with a space before the paragraph if an answer stands at its very start."""
    first = F.array_contains(offsets, 0)
    return F.struct(F.when(first, F.transform(offsets, lambda x: x + 1)).otherwise(offsets).alias("offsets"), F.when(first, F.concat(F.lit(" "), paragraph)).otherwise(paragraph).alias("paragraph"))


def word_index(text: Column, offset: Column) -> Column:
    """How many words end before a character."""
    head = F.trim(F.regexp_replace(F.substr(text, F.lit(1), offset), r"(?U)\s+", " "))
    return F.when(F.length(head) == 0, F.lit(0)).otherwise(F.size(F.split(head, " ")))


def glyph_at(widths: Column, offset: Column) -> Column:
    """The index of the chunk whose glyphs hold a character: chunks with counts of glyphs are walked through in order."""
    walked = F.aggregate(widths, F.struct(F.lit(0).alias("sum"), F.lit(0).alias("k")), lambda acc, w: F.struct((acc["sum"] + w).alias("sum"), (acc["k"] + F.when(acc["sum"] + w <= offset, 1).otherwise(0)).alias("k")))
    return walked["k"]
