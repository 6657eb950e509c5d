"""Text helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


# fixed values: the characters that count as white space, in code point order
WHITESPACE = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WHITESPACE, " "))


def slug(text: Column) -> Column:
    """The part before `@` as a lower-case identifier of a-z, 0-9 and single dashes."""
    name = F.lower(F.element_at(F.split(text, "@"), 1))
    dashed = F.regexp_replace(F.regexp_replace(name, "[^a-z0-9-]", "-"), "-+", "-")
    return F.btrim(dashed, F.lit("-"))


def split_clean(text: Column) -> Column:
    """Parts between commas and white space, without empty ones."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[, \t\n\r\f]+")
    return F.filter(parts, lambda p: p != "")


def chunks(text: Column, size: int = 700, overlap: int = 120) -> Column:
    """Overlapping windows over the collapsed text; every character is in at least one."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    step = size - overlap
    steps_per_chunk = -(-size // step)

    def windows(steps: Column) -> Column:
        return F.transform(
            steps,
            lambda _, i: F.substring(F.array_join(F.slice(steps, i + 1, steps_per_chunk), ""), 1, size),
        )

    # one pass cuts the text into steps; a chunk is its step and the start of the next ones
    steps = F.regexp_extract_all(collapse_whitespace(text), F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    return F.filter(let(steps, windows), lambda p: F.trim(p) != "")


def wrap_line(line: Column, width: int = 95) -> Column:
    """Greedy word wrap of one line, as an array of lines; an empty line stays one empty line."""
    words = F.filter(F.split(F.regexp_replace(line, WHITESPACE, " "), " "), lambda w: w != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def add(state: Column, word: Column) -> Column:
        full = F.length(state["open"]) + F.length(word) + 1 > width
        return F.struct(
            F.when(full, F.array_append(state["done"], state["open"]))
            .otherwise(state["done"])
            .alias("done"),
            F.when(full | (state["open"] == ""), word)
            .otherwise(F.concat(state["open"], F.lit(" "), word))
            .alias("open"),
        )

    def close(state: Column) -> Column:
        return F.when(state["open"] == "", state["done"]).otherwise(
            F.array_append(state["done"], state["open"])
        )

    return F.when(line == "", F.array(F.lit(""))).otherwise(F.aggregate(words, start, add, close))


def snippet(text: Column, size: int = 300) -> Column:
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit(" ..."))).otherwise(text)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def contains_ci(text: Column, needle: str) -> Column:
    return F.contains(F.lower(text), F.lit(needle.lower()))


def visible_text(html: Column) -> Column:
    """Text of a page: scripts, styles, comments and tags removed, white space collapsed."""
    no_blocks = F.regexp_replace(
        html, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " "
    )
    return collapse_whitespace(F.regexp_replace(no_blocks, r"(?s)<[^>]*>", " "))
