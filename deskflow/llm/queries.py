"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import language, quality
from .chat import format_conversations, linear_tree, read_back
from .decontaminate import find_items
from .factors import remove_earlier_passages
from .identifiers import KINDS, count_of, find_identifiers, written
from .importance import importance_sample
from .mixing import mix_sources
from .packing import packed
from .registry import ORACLES, QUERIES, query, table
from .signatures import shingle_components
from .subspaces import near_vectors
from .suffixes import remove_repeated_strings
from .trie import rebuilt_trie

__all__ = ["ORACLES", "QUERIES"]

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op1_signatures",
    rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1) + 1))) AS i FROM d)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
),
e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
),
r AS (
  SELECT a AS doc_id, a AS z FROM (SELECT DISTINCT a FROM e)
  UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.z
),
m AS (SELECT doc_id, min(z) AS low FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.low, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
""",
)
def signatures(spark, base):
    """Documents linked by the Jaccard similarity of their 4-word shingles, as components."""
    return shingle_components(table(spark, base, "documents"), 4, 85, 100).drop("key", "component")


@query("op2_mixing")
def mixing(spark, base):
    """What a mix of all sources to target weights takes of each document."""
    return mix_sources(table(spark, base, "documents"))


@query("op3_language")
def languages(spark, base):
    """The language of every document, learned from four fifths of the labelled ones."""
    docs = table(spark, base, "documents")
    held_out = F.coalesce(language.fold(F.col("doc_id"), 5) == 0, F.lit(False))
    model = language.fit(docs.where(language.fold(F.col("doc_id"), 5) != 0))
    out = language.predict(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query("op4_identifiers")
def identifiers(spark, base):
    """Personal data in every document, by form and by learned patterns."""
    found = find_identifiers(table(spark, base, "documents"))
    return found.select(
        "doc_id", *[count_of("known", k).alias(f"n_{k}") for k in KINDS],
        F.sha2(written("known"), 256).alias("base_sha256"), written("spans").alias("spans"),
    )


@query("op5_decontaminate")
def decontaminate(spark, base):
    """Benchmark items that stand in documents, exactly or with a few edits."""
    return find_items(table(spark, base, "documents"), table(spark, base, "benchmark")).drop("key")


@query("op7_suffixes")
def suffixes(spark, base):
    """Bytes of each document that are left after strings of 400 bytes that occur twice are removed."""
    return remove_repeated_strings(table(spark, base, "documents")).drop("spans")


@query("op8_quality")
def qualities(spark, base):
    """The quality of every document, learned from two thirds of the labels."""
    docs = table(spark, base, "documents").select("doc_id", "text")
    labels = table(spark, base, "labels").select("doc_id", "quality").where("quality is not null")
    model = quality.fit(docs, labels.where(language.fold(F.col("doc_id"), 3) != 1))
    held_out = F.coalesce(language.fold(F.col("doc_id"), 3) == 1, F.lit(False))
    return quality.scored(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query(
    "op9_factors",
    rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
f AS (SELECT g, min(doc_id) AS low FROM g GROUP BY g HAVING count(*) > 1),
hit AS (SELECT DISTINCT doc_id, i + j AS k FROM g JOIN f USING (g), range(0, 13) r(j) WHERE doc_id > low),
gone AS (SELECT doc_id, list(k) AS ks FROM hit GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, w, coalesce(ks, []) AS ks FROM d LEFT JOIN gone USING (doc_id)
),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM d),
rest AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.k) AS t FROM words
  LEFT JOIN hit ON hit.doc_id = words.doc_id AND hit.k = words.k WHERE hit.k IS NULL GROUP BY words.doc_id
)
SELECT kept.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(ks) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM kept LEFT JOIN rest USING (doc_id)
""",
)
def factors(spark, base):
    """Words of each document that are left after passages of earlier documents are removed."""
    out = remove_earlier_passages(table(spark, base, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


@query(
    "op10_subspaces",
    """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
),
ok AS (
  SELECT vec_id, label, x FROM v WHERE label IS NOT NULL AND len(x) > 0
    AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0
),
e AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98 OR a.x = b.x
),
r AS (
  SELECT a AS vec_id, a AS z FROM (SELECT DISTINCT a FROM e)
  UNION SELECT r.vec_id, e.b FROM r JOIN e ON e.a = r.z
),
m AS (SELECT vec_id, min(z) AS low FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM e GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, coalesce(m.low, v.vec_id) AS component_id,
  coalesce(m.low, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN n USING (vec_id) LEFT JOIN m USING (vec_id)
""",
)
def subspaces(spark, base):
    """Near copies among all embeddings of one label."""
    return near_vectors(table(spark, base, "embeddings"))


@query(
    "op6_chat",
    r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
l AS (
  SELECT *, len(replace(replace(replace(text, '\', '\\'), '<', '\l'), '#', '\h'))
    + CASE WHEN role IN ('system', 'user', 'assistant') THEN len(role)
      ELSE 1 + len(replace(replace(replace(replace(role, '\', '\\'), '<', '\l'), '#', '\h'), ':', '\c')) END + 14 AS size
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM l GROUP BY conv_id
""",
)
def chat(spark, base):
    """All conversations formatted, and what is read back from the formatted text."""
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"),
    )
    said = table(spark, base, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = read_back(format_conversations(linear_tree(said)))
    line = F.lit("\n")
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line)), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def crc32_sql(text: str) -> str:
    """CRC-32 of a text's bytes, given the table `t` of _CRC_TABLE."""
    bytes_ = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    return f"xor(list_reduce({bytes_}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"


_CRC_TABLE = """(SELECT list_transform(range(256), lambda i: list_reduce([0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t)"""


@query(
    "op11_importance",
    rf"""
WITH w AS (
  SELECT doc_id, 0 AS side, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL SELECT NULL, 1, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
),
f AS (
  SELECT doc_id, side, g, count(*) AS n FROM (
    SELECT doc_id, side, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
      list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS g FROM w
  ) GROUP BY doc_id, side, g
),
b AS (SELECT g, {crc32_sql("g")} % 10000 AS b FROM (SELECT DISTINCT g FROM f), {_CRC_TABLE}),
c AS (
  SELECT b, CAST(coalesce(sum(n) FILTER (side = 0), 0) AS DOUBLE) AS s, CAST(coalesce(sum(n) FILTER (side = 1), 0) AS DOUBLE) AS t
  FROM f JOIN b USING (g) GROUP BY b
),
gain AS (
  SELECT b, CAST(floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM c) + 10000) / ((s + 1) * ((SELECT sum(t) FROM c) + 10000)))) AS BIGINT) AS gain FROM c
),
weight AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
  FROM f JOIN b USING (g) JOIN gain USING (b) WHERE side = 0 GROUP BY doc_id
),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM w LEFT JOIN weight USING (doc_id) WHERE side = 0
),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_words >= 20
  QUALIFY rank <= 5 * count(*) OVER () // 100
)
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN drawn USING (doc_id)
""",
)
def importance(spark, base):
    """The documents most like the benchmark, drawn by weight."""
    return importance_sample(table(spark, base, "documents"), table(spark, base, "benchmark"))


@query(
    "op12_trie",
    rf"""
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL
),
c AS (
  SELECT conv_id AS c, conv_id - conv_id % 20 AS base, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM o), {_CRC_TABLE}
),
r AS (
  SELECT c, role, text, 0 AS own, k FROM c JOIN o ON o.conv_id = base AND k <= h
  UNION ALL SELECT c, role, text, 1, k FROM c JOIN o ON o.conv_id = c AND k > h
),
p AS (
  SELECT c, row_number() OVER w AS d, text, list(role || chr(1) || sha256(text)) OVER w AS path FROM r WINDOW w AS (PARTITION BY c ORDER BY own, k)
),
size AS (SELECT c.c, count(p.c) AS size FROM c LEFT JOIN p ON p.c = c.c GROUP BY c.c),
a AS (
  SELECT c, d, text, min(c) OVER (PARTITION BY path) AS label, count(*) OVER (PARTITION BY path) AS n FROM p
  UNION ALL SELECT c, 0, '', (SELECT min(c) FROM c), (SELECT count(*) FROM c) FROM c
),
node AS (SELECT DISTINCT d, label, n, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM a),
up AS (SELECT x.d, x.label, y.label AS parent FROM a x JOIN a y ON x.c = y.c AND y.d = x.d - 1 AND x.c = x.label),
kids AS (SELECT d - 1 AS d, parent AS label, count(*) AS n_children FROM up GROUP BY ALL),
own AS (
  SELECT d, label, n, coalesce(n_children, 0) AS n_children, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf, (n - 1) * words AS saved
  FROM node LEFT JOIN kids USING (d, label)
),
below AS (
  SELECT a.d, a.label, CAST(sum(leaf) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM own JOIN a ON a.c = own.label AND a.d <= own.d GROUP BY a.d, a.label
),
ends AS (SELECT a.d, a.label, sha256(string_agg(CAST(a.c AS VARCHAR), ',' ORDER BY a.c)) AS ends FROM a JOIN size ON size.c = a.c AND size = d GROUP BY a.d, a.label)
SELECT label AS conv_id, d AS depth, parent AS parent_conv_id, n AS n_convs, n_children, n_leaves, saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM own LEFT JOIN up USING (d, label) JOIN below USING (d, label) LEFT JOIN ends USING (d, label)
""",
)
def trie(spark, base):
    """All conversations, rebuilt with shared heads, as one trie of prefixes."""
    return rebuilt_trie(table(spark, base, "conversations"))


@query("op13_packing")
def packing(spark, base):
    """All documents as tokens, packed into sequences of 2048."""
    return packed(table(spark, base, "documents"), tokenizer_path("word_bpe_49k.json"))


def tokenizer_path(name: str) -> str:
    """Where the installed vocabularies are; only this query asks for one."""
    import public_tokenizers

    return public_tokenizers.path(name)
