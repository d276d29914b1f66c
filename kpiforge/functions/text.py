"""Text cleaning as column expressions. Patterns follow Python's rules: (?U) for Unicode white space, (?d) for line ends."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What cleaning deletes, curly quotes among it, and the signs that a regular expression would read as its own.
DELETED = "“”" + "".join(map(chr, (*range(9), 11, 12, *range(14, 32), *range(127, 256))))
METACHARACTERS = "()^+*$|\\?[]{}"


def _squeezed(text: Column, breaks: str) -> Column:
    """Breaks as spaces; curly quotes plain at the edges of a list, otherwise gone as control and Latin-1 characters are; then
    runs of white space. Characters are looked at once."""
    opened = F.replace(text, F.lit("[“"), F.lit('["'))
    closed = F.replace(opened, F.lit("”]"), F.lit('"]'))
    return F.regexp_replace(F.translate(closed, breaks + DELETED, " " * len(breaks)), r"(?U)\s{2,}", " ")


def clean_for_curation(text: Column) -> Column:
    """One line of plain characters: quotes, line breaks and tabs, control and Latin-1 characters, runs of white space."""
    return _squeezed(text, "\n\t")


def letters_when_clean(text: Column) -> Column:
    """letters() of what clean_for_curation() makes of a text, without cleaning it."""
    return F.length(F.regexp_replace(text, r"[\P{L}\x7f-\xff]+", ""))


def clean_for_answers(text: Column) -> Column:
    """As for curation but tabs stay until they are squeezed; then no metacharacters, lower case, no runs of dots."""
    plain = F.translate(_squeezed(text, "\n"), METACHARACTERS, "")
    return F.regexp_replace(F.lower(plain), r"\.{2,}", "")


def letters(text: Column) -> Column:
    """How many letters a text has."""
    return F.length(F.regexp_replace(text, r"\P{L}+", ""))


def numerals(text: Column) -> Column:
    """How many characters of a text are numeric in the sense of Unicode."""
    return F.regexp_count(text, F.lit(r"\p{N}"))


def stripped(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def paragraph_list(text: Column) -> Column:
    """The paragraphs in a cell such as '["one", "two"]'; one wrong bracket is repaired; null if it is no list."""
    cell = stripped(text)
    head = F.when(F.substring(cell, 1, 1).isin("{", "]"), F.concat(F.lit("["), F.substr(cell, F.lit(2)))).otherwise(cell)
    body = F.substr(head, F.lit(1), F.greatest(F.length(head) - 1, F.lit(0)))
    both = F.when(F.endswith(head, F.lit("}")) | F.endswith(head, F.lit("[")), F.concat(body, F.lit("]"))).otherwise(head)
    inner = F.substr(both, F.lit(3), F.greatest(F.length(both) - 4, F.lit(0)))
    return F.when(F.startswith(both, F.lit("[")) & F.endswith(both, F.lit("]")) & (F.length(both) >= 4), F.split(inner, '", ?"'))


def sentence_list(text: Column) -> Column:
    """The sentences of an annotation: a list literal of quoted strings, or a plain string as the only one; null if broken."""
    as_list = F.startswith(text, F.lit("[")) | F.endswith(text, F.lit("]"))
    whole = F.startswith(text, F.lit('["')) & F.endswith(text, F.lit('"]')) & (F.length(text) >= 4)
    return F.when(~as_list, F.array(text)).when(whole, paragraph_list(text))


def page_list(text: Column) -> Column:
    """Page numbers in a cell such as '[02, 5]'; null if it is no list, null elements for what is no number."""
    inner = F.regexp_replace(text, r"^\[|\]$", "")
    return F.when(F.rlike(text, F.lit(r"(?d)^\[.*\]$")), F.transform(F.split(inner, ","), lambda x: F.trim(x).try_cast("int")))


def answer_line(text: Column) -> Column:
    """An answer on one line, without white space at its ends."""
    return stripped(F.replace(text, F.lit("\n"), F.lit(" ")))


def pdf_name(text: Column) -> Column:
    """A report's file name: ',pdf' mended, '.pdf' at the end, no white space around."""
    mended = F.replace(F.trim(text), F.lit(",pdf"), F.lit(".pdf"))
    return F.when(F.endswith(mended, F.lit(".pdf")), mended).otherwise(F.concat(mended, F.lit(".pdf")))


def file_stem(path: Column) -> Column:
    """The last segment of a path without its extension."""
    return F.regexp_replace(F.substring_index(F.translate(path, "\\", "/"), "/", -1), r"\.[^.]*$", "")


def company_of(path: Column) -> Column:
    """The last folder of a path."""
    return F.get(F.split(path, "/"), F.size(F.split(path, "/")) - 2)


def safe_file_name(text: Column) -> Column:
    """Brackets and parentheses become underscores."""
    return F.translate(text, "[]()", "____")


def without_trailing_slash(path: Column) -> Column:
    """A path without one slash at its end."""
    return F.regexp_replace(path, "/$", "")


def lower_letters(text: Column) -> Column:
    """Only a to z and spaces are left, so capitals go too; used for lengths."""
    return F.regexp_replace(text, "[^a-z ]", "")


def question_key(text: Column) -> Column:
    """A question without its year: what is before ' in year', with a question mark."""
    head = F.substring_index(text, " in year", 1)
    return F.when(F.endswith(head, F.lit("?")), head).otherwise(F.concat(head, F.lit("?")))


def with_year(question: Column, year: Column) -> Column:
    """A question about a year: the text before its first question mark, then the year; whole numbers lose decimals."""
    whole = F.coalesce(year.try_cast("double").cast("long").cast("string"), year)
    return F.concat(F.substring_index(question, "?", 1), F.lit(" in year "), whole, F.lit("?"))


def kpi_label(kpi_id: Column) -> Column:
    """A KPI's number without needless decimals."""
    return F.regexp_replace(kpi_id.cast("double").cast("string"), r"\.0$", "")
