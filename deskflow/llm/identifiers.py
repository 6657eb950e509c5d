"""Personal data by patterns that known entities teach.

Seeds are e-mail addresses, IP addresses, card and phone numbers found by their form. The words around a seed are a
lexical pattern of its kind. Patterns and instances (a kind and a value in plain form) are the two sides of a graph
that is scored in rounds: a pattern's confidence is the mean confidence of all that stands in it, counted over the
corpus; an instance's is that of its best patterns; a seed's is 1. Whatever has digits or an at sign stands in
patterns, so a pattern that is as common before other numbers earns no trust. In the end, identifiers of a looser
form that a trusted pattern announces, or whose plain value is that of a seed elsewhere, are found as well.

Scanning is one pass that keeps mentions only; all counting and scoring are joins and sums over their edges.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import moved, row_key, stored

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 4
TRUST = 0.8  # confidence from which a pattern or an instance counts as found
SUPPORT = 3  # different seeds that a pattern must have been learned from
BASIS = 5.0  # weight of doubt: a pattern is believed as if it had stood before so many strangers times (1 - TRUST)

# fixed values: the forms of the known kinds
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# looser forms, which need a trusted pattern
_LOOSE = {
    "email": re.compile(r"[\w.%+-]{1,64} ?(?:@|\(at\)|\[at\]) ?[\w-]{1,64}(?: ?(?:\.|\(dot\)|\[dot\]) ?[\w-]{1,64})+"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?: ?[.,:] ?|\[\.\])[0-9]{1,3}){3}(?![0-9.])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[ .-]?[0-9]){12,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])\(?[0-9]{2,4}\)?(?:[ ./-]?[0-9]{2,4}){2,4}(?![0-9])"),
}
_TOKEN = re.compile(r"\S+")
_SIGN = re.compile(r"[0-9@]")
_AT = re.compile(r" ?(?:@|\(at\)|\[at\])")
_LOOSE_LOCAL = re.compile(r"[\w.%+-]")
WORD, LONG = 64, "\u2026"  # longest word that a pattern spells out, and what stands for longer ones
REACH = 70  # characters around a digit in which a looser form that has it must lie; the longest, a card, has 37


def luhn(digits: str) -> bool:
    double = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
    total = sum(double[int(c)] if i % 2 else int(c) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def known_spans(text: str) -> list[tuple[int, int, int]]:
    """(number of the kind, start, end) by kind and start: leftmost matches of each kind that do not overlap.

    Each form is matched in time that is linear in the text, also where a run of its characters never matches.
    """
    out = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((0, start, found.end()))
            last = found.end()
        at = text.find("@", max(at + 1, last))
    for m in _NUMBERS.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts = [(n.start(), n.end()) for n in re.finditer("[0-9]+", m[0])]
        for i in range(0, len(parts) - 3, 4):
            four = [m[0][a:b].lstrip("0") or "0" for a, b in parts[i : i + 4]]
            if all(len(x) <= 3 and int(x) <= 255 for x in four):
                out.append((1, m.start() + parts[i][0], m.start() + parts[i + 3][1]))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def plain(kind: str, value: str) -> str:
    """A value without the ways to write it."""
    if kind == "email":
        value = re.sub(r" ?(?:\(at\)|\[at\]|@) ?", "@", value.lower())
        return re.sub(r" ?(?:\(dot\)|\[dot\]|\.) ?", ".", value)
    digits = re.findall("[0-9]+", value)
    if kind == "ip":
        return ".".join(d.lstrip("0") or "0" for d in digits)
    return "".join(digits)[-10:] if kind == "phone" else "".join(digits)


def word_of(word: str) -> str:
    return word.lower() if len(word) <= WORD else LONG


def words_before(text: str, start: int) -> list[str]:
    """The last two words before a place; a long word stands for all before it as well."""
    reach = 3 * WORD
    while True:
        words = text[max(0, start - reach) : start].split()
        if words and len(words[-1]) > WORD:
            return [LONG, LONG]
        # the first of them may be cut, which does not matter where it is long or not among the last two
        if len(words) > 2 or reach >= start or len(words) == 2 and len(words[0]) > WORD:
            return [word_of(w) for w in words[-2:]]
        reach *= 4


def word_after(text: str, end: int) -> str | None:
    reach = 2 * WORD
    while True:
        part = text[end : end + reach]
        words = part.split(None, 1)
        if len(words) > 1 or end + reach >= len(text) or words and (len(words[0]) > WORD or part[-1].isspace()):
            return word_of(words[0].rstrip()) if words else None
        reach *= 4


def patterns_around(text: str, start: int, end: int) -> list[str]:
    """Two words before; one before and one after: whole words in lower case, those of more than WORD characters as LONG."""
    left, right = words_before(text, start), word_after(text, end)
    out = [f"{left[-2]} {left[-1]} _"] if len(left) > 1 else []
    return out + ([f"{left[-1]} _ {right}"] if left and right else [])


def value_of(token: str) -> str:
    """A token as a value of the graph: different tokens are different values, and none is longer than 64 characters."""
    return token if len(token) < 64 else hashlib.sha256(token.encode("utf-8", "surrogatepass")).hexdigest()


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans in order, overlapping ones as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def is_free(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    i = bisect_left(spans, (end,))
    return i == 0 or spans[i - 1][1] <= start


def windows_of(text: str) -> list[tuple[int, int]]:
    """What lies around digits and at signs, whole words; windows that touch or overlap are one."""
    out: list[tuple[int, int]] = []
    for m in _SIGN.finditer(text):
        s = m.start()
        if out and s + REACH <= out[-1][1]:
            continue
        a, b = text.rfind(" ", 0, max(0, s - REACH)) + 1, text.find(" ", s + REACH)
        b = b if b >= 0 else len(text)
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def loose_spans(text: str, windows: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the looser forms: what a search of the whole text for each of them finds.

    E-mails have no greatest length, so they are matched from each at sign, however written: one begins where the
    characters before its sign do, and whether it matches depends on what follows the sign only.
    """
    out, last = [], 0
    for at in _AT.finditer(text):
        start = at.start()
        least = max(last, start - 64)
        while start > least and _LOOSE_LOCAL.match(text, start - 1):
            start -= 1
        found = _LOOSE["email"].match(text, start) if start < at.start() else None
        if found:
            out.append(("email", start, found.end()))
            last = found.end()
    for kind in ("ip", "card", "phone"):
        out += [(kind, m.start(), m.end()) for a, b in windows for m in _LOOSE[kind].finditer(text, a, b)]
    return out


def mentions_of(text: str, known: list[tuple[int, int, int]]) -> list[tuple[str, str, int, int, bool, list[str]]]:
    """(kind, plain value, start, end, seed, patterns) of seeds, looser forms, and other tokens (kind empty)."""
    out, taken = [], []
    for k, start, end in known:
        out.append((KINDS[k], plain(KINDS[k], text[start:end]), start, end, True, patterns_around(text, start, end)))
        taken.append((start, end))

    taken = joined(taken)

    windows = windows_of(text)
    for kind, start, end in loose_spans(text, windows):
        if is_free(taken, start, end):
            out.append((kind, plain(kind, text[start:end]), start, end, False, patterns_around(text, start, end)))
    seen = joined([(m[2], m[3]) for m in out])
    for a, b in windows:
        for m in _TOKEN.finditer(text, a, b):
            if _SIGN.search(m[0]) and is_free(seen, m.start(), m.end()):
                out.append(("", value_of(m[0]), m.start(), m.end(), False, patterns_around(text, m.start(), m.end())))
    return out


MENTION = "struct<kind:string,value:string,start:int,end:int,seed:boolean,patterns:array<string>>"


def scanned(docs: DataFrame) -> DataFrame:
    """row, key, doc_id, known (kind, start, end) and mentions of each row of `docs` (doc_id, text)."""

    def rows(batches):
        for batch in batches:
            known, mentions = [], []
            for text in batch.column("text").to_pylist():
                spans = known_spans(text) if text else []
                known.append([{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans])
                mentions.append(
                    [dict(zip(("kind", "value", "start", "end", "seed", "patterns"), m)) for m in (mentions_of(text, spans) if text else [])]
                )
            span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
            mention = pa.struct([
                ("kind", pa.string()), ("value", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                ("seed", pa.bool_()), ("patterns", pa.list_(pa.string())),
            ])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), pa.array(known, pa.list_(span)), pa.array(mentions, pa.list_(mention))],
                ["key", "doc_id", "known", "mentions"],
            )

    # only texts with a digit or an at sign, however written, are handed over
    text = F.when(F.col("text").rlike(r"[0-9@]|\(at\)|\[at\]"), F.col("text"))
    out = docs.select(row_key().alias("key"), "doc_id", text.alias("text")).mapInArrow(rows, f"key long, doc_id long, known array<struct<kind:string,start:int,end:int>>, mentions array<{MENTION}>")
    return stored(out.withColumn("row", F.monotonically_increasing_id()), "mentions")


def believed(mentions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trusted patterns (kind, pattern) and known values (kind, value), from mentions (kind, value, seed, patterns)."""
    seeds = mentions.where("seed").select("kind", "value").distinct()
    stands = mentions.select("kind", "value", "seed", F.explode("patterns").alias("pattern"))
    edges = stands.groupBy("kind", "value", "pattern").agg(F.count("*").alias("n"), F.max("seed").alias("seed"))
    # a pattern is one kind's: how often it stands before anything, and before values of the kind
    induced = edges.where("seed").groupBy(F.col("kind").alias("of"), "pattern").agg(F.countDistinct("value").alias("seeds")).where(f"seeds >= {SUPPORT}")
    induced = stored(induced, "induced")
    edges = stored(edges.join(moved(induced.select("of", "pattern")), "pattern"), "edges")
    whole = edges.groupBy("of", "pattern").agg(F.sum("n").alias("whole"))
    own = stored(edges.where("kind = of").select("kind", "value", "pattern", "n").join(seeds.withColumn("seed", F.lit(True)), ["kind", "value"], "left"), "own")
    sure = own.withColumn("belief", F.when(F.col("seed"), 1.0).otherwise(0.0))
    for _ in range(ROUNDS):
        score = sure.groupBy("kind", "pattern").agg(F.sum(F.col("n") * F.col("belief")).alias("good"))
        score = score.join(whole.withColumnRenamed("of", "kind"), ["kind", "pattern"])
        score = stored(score.select("kind", "pattern", (F.col("good") / (F.col("whole") + BASIS * (1 - TRUST))).alias("trust")), "patterns")
        # an unknown value is believed as much as the patterns that it stands in, each as often as it does
        value = own.join(moved(score), ["kind", "pattern"]).groupBy("kind", "value").agg((F.sum(F.col("n") * F.col("trust")) / F.sum("n")).alias("belief"))
        belief = F.when(F.col("seed"), 1.0).otherwise(F.coalesce("belief", F.lit(0.0)))
        sure = own.join(moved(value), ["kind", "value"], "left").withColumn("belief", belief)
        sure = stored(sure.select("kind", "value", "pattern", "n", "seed", "belief"), "beliefs")
    return score.where(F.col("trust") >= TRUST).select("kind", "pattern"), seeds


def find_identifiers(docs: DataFrame) -> DataFrame:
    """key (see row_key), doc_id, known and spans for each row of `docs` (doc_id, text): arrays of kind, start and end in code points.

    known has what is found by form, by kind and start; spans has all of it and what patterns and known values add,
    which never overlaps the former. Null texts are empty. Equal rows are rows of their own. No rows give no rows;
    other columns are ignored.
    """
    rows = scanned(docs)
    mentions = rows.where(F.size("mentions") > 0).select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    trusted, seeds = believed(mentions)
    loose = mentions.where("not seed and kind <> ''")
    told = loose.withColumn("pattern", F.explode("patterns")).join(moved(trusted), ["kind", "pattern"], "left_semi").select("row", "kind", "start", "end")
    same = loose.where(F.length("value") >= 7).join(moved(seeds), ["kind", "value"], "left_semi").select("row", "kind", "start", "end")
    added = told.unionByName(same).groupBy("row").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))
    place = "array_position(array('email', 'ip', 'card', 'phone'), {0}.kind) * 4294967296L + {0}.start"
    ordered = F.expr(f"array_sort(spans, (x, y) -> cast(sign({place.format('x')} - ({place.format('y')})) as int))")
    out = rows.select("row", "key", "doc_id", "known").join(moved(added), "row", "left")
    out = out.withColumn("spans", F.when(F.col("added").isNull(), F.col("known")).otherwise(F.concat("known", "added")))
    return out.select("key", "doc_id", "known", ordered.alias("spans"))


def written(spans: str):
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: str, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(text: str | None, spans: list) -> str | None:
    """The text with each span, overlapping ones together, replaced by its kind in brackets."""
    if not text or not spans:
        return text
    out, last = [], 0
    for kind, start, end in sorted(((s["kind"], s["start"], s["end"]) for s in spans), key=lambda s: (s[1], -s[2])):
        if start >= last:
            out += [text[last:start], f"[{kind}]"]
        last = max(last, end)
    return "".join(out) + text[last:]

