"""Text, JSON, search and conversation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.vectors import TERM_BUCKETS, term_counts, unit, vector_literal
from ..operators import lookup, memory
from ..operators.names import find_names
from ..operators.postings import Postings
from ..operators.search import embed_with, nearest, nearest_approx, recall
from ..session import work_dir
from ..sources.tables import stream_table
from ..sources.views import Desk
from ..streaming.changes import KeyedTable, run_apply
from .oracle_views import SPACE, squash, terms
from .registry import query


@query(
    "str_slug",
    """SELECT page_id, trim(regexp_replace(regexp_replace(lower(string_split(url || '@desk', '@')[1]), '[^a-z0-9-]', '-', 'g'),
              '-+', '-', 'g'), '-') AS slug FROM pages""",
)
def str_slug(d: Desk):
    return d.table("pages").select("page_id", tx.slug(F.concat("url", F.lit("@desk"))).alias("slug"))


@query(
    "str_split_clean",
    r"""SELECT p_partkey, len(parts)::INTEGER AS n_parts, array_to_string(parts, '|') AS parts FROM (
         SELECT p_partkey, list_filter(regexp_split_to_array(p_name || ', ' || p_brand || ' ,' || p_type, '[, \t\n\r\f]+'),
                lambda x: x <> '') AS parts FROM part)""",
)
def str_split_clean(d: Desk):
    text = F.concat(F.col("p_name"), F.lit(", "), F.col("p_brand"), F.lit(" ,"), F.col("p_type"))
    parts = tx.split_clean(text)
    return d.table("part").select(
        "p_partkey", F.size(parts).alias("n_parts"), F.concat_ws("|", parts).alias("parts")
    )


@query("chunk_documents", "SELECT doc_id, source, chunk_idx, content FROM v_chunks")
def chunk_documents(d: Desk):
    return d.chunks().select("doc_id", "source", "chunk_idx", "content")


_WRAP_WORDS = f"""list_filter(string_split(regexp_replace(line, '{SPACE}', ' ', 'g'), ' '), lambda w: w <> '')"""


@query(
    "word_wrap",
    f"""WITH l AS (SELECT thread_id, version, unnest(string_split("text", chr(10))) AS line,
                          unnest(range(0, len(string_split("text", chr(10))))) AS line_no FROM v_turns),
             f AS (SELECT *, list_reduce(list_transform({_WRAP_WORDS}, lambda w: {{'done': [w], 'open': w}}),
                     lambda s, x: CASE WHEN length(s.open) + length(x.open) + 1 > 95
                                       THEN {{'done': list_append(s.done, s.open), 'open': x.open}}
                                       WHEN s.open = '' THEN {{'done': s.done, 'open': x.open}}
                                       ELSE {{'done': s.done, 'open': s.open || ' ' || x.open}} END,
                     {{'done': []::VARCHAR[], 'open': ''}}) AS s FROM l),
             w AS (SELECT thread_id, version, line_no, CASE WHEN line = '' THEN [''] WHEN s.open = '' THEN s.done
                          ELSE list_append(s.done, s.open) END AS parts FROM f)
        SELECT thread_id, version, CAST(line_no AS INTEGER) AS line_no, CAST(unnest(range(0, len(parts))) AS INTEGER) AS part_no,
               unnest(parts) AS wrapped FROM w""",
)
def word_wrap(d: Desk):
    """Every line of every conversation turn, wrapped at 95 characters."""
    lines = d.turns.select("thread_id", "version", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select(
        "thread_id", "version", "line_no", F.posexplode(tx.wrap_line(F.col("line"))).alias("part_no", "wrapped")
    )


@query(
    "snippet",
    """SELECT thread_id, version, CASE WHEN length("text") > 300 THEN substr("text", 1, 300) || ' ...' ELSE "text" END AS snippet
       FROM v_turns""",
)
def snippet(d: Desk):
    return d.turns.select("thread_id", "version", tx.snippet(F.col("text")).alias("snippet"))


@query("url_basename", "SELECT page_id, string_split(url, '/')[-1] AS base_name FROM pages")
def url_basename(d: Desk):
    return d.table("pages").select("page_id", tx.base_name(F.col("url")).alias("base_name"))


@query("json_extract", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_extract(d: Desk):
    """Responses of three shapes; the value comes from whichever part is filled."""
    shape = F.col("event_id") % 3
    body = (
        F.when(shape == 0, F.concat(F.lit('{"outputs":['), F.col("props"), F.lit("]}")))
        .when(shape == 1, F.concat(F.lit('{"outputs":[],"predictions":['), F.col("props"), F.lit("]}")))
        .otherwise(F.col("props"))
    )
    return d.table("events").select("event_id", lookup.first_result(body, "k int")["k"].alias("k"))


# --- search ---------------------------------------------------------------


@query(
    "embed_documents",
    f"""WITH e AS (SELECT doc_id, chunk_idx, embedding AS c FROM v_chunkterms),
             n AS (SELECT *, sqrt(list_sum(list_transform(c, lambda x: x * x))) AS len FROM e)
        SELECT doc_id, chunk_idx, list_aggregate(list_transform(c, lambda x:
               CAST(CAST(floor(CASE WHEN len > 0 THEN x / len ELSE 0 END * 1e6 + 0.5) AS BIGINT) AS VARCHAR)), 'string_agg', ',') AS vec
        FROM n""",
)
def embed_documents(d: Desk):
    """Unit vectors of word counts for all chunks, cut and counted in one pass over Arrow batches."""
    return d.chunks(buckets=TERM_BUCKETS).select("doc_id", "chunk_idx", vector_literal(unit(F.col("embedding"))).alias("vec"))


_RANK = """SELECT * EXCLUDE ("full"), floor("full" * 1e6 + 0.5) / 1e6 AS score,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY "full" DESC, {keys}) AS INTEGER) AS rank
FROM {source} QUALIFY rank <= 4"""


@query(
    "embed_batches",
    """SELECT doc_id, chunk_idx, CAST(length(content) AS BIGINT) AS n_chars,
              CAST(length(content) - length(replace(content, ' ', '')) AS BIGINT) AS n_blanks FROM v_chunks""",
)
def embed_batches(d: Desk):
    """Every chunk embedded by a model that takes sixteen texts per call; the model here counts characters."""

    def model(texts: list[str]) -> list[list[float]]:
        if not 0 < len(texts) <= 16:
            raise ValueError(f"{len(texts)} texts in one call")
        return [[float(len(t)), float(t.count(" "))] for t in texts]

    rows = d.chunks().select("doc_id", "chunk_idx", "content")
    return embed_with(rows, "content", model).select(
        "doc_id", "chunk_idx", F.get("embedding", 0).cast("long").alias("n_chars"),
        F.get("embedding", 1).cast("long").alias("n_blanks"),
    )


_CITATION = "'[' || source || ' · ' || lang || '] ' || content"


@query(
    "semantic_search",
    f"""WITH q AS (SELECT item_id AS query_id, {terms(squash('"text"'))} AS qv FROM benchmark),
             c AS (SELECT doc_id, chunk_idx, embedding AS cv, sqrt(list_dot_product(embedding, embedding)) AS cl FROM v_chunkterms),
             s AS (SELECT query_id, doc_id, chunk_idx, round(list_dot_product(qv, cv)
                          / (cl * sqrt(list_dot_product(qv, qv))), 12) AS "full" FROM q, c
                   WHERE cl > 0 AND list_dot_product(qv, qv) > 0),
             r AS ({_RANK.format(keys='doc_id, chunk_idx', source='s')})
        SELECT r.*, {_CITATION} AS citation FROM r JOIN v_cited USING (doc_id, chunk_idx)""",
)
def semantic_search(d: Desk):
    """Every benchmark text as a query over the chunks of all documents; hits cite their whole passage."""
    queries = d.table("benchmark").select(
        F.col("item_id").alias("query_id"), term_counts(tx.collapse_whitespace(F.col("text"))).alias("embedding")
    )
    return cited(d, nearest(d.chunks(buckets=TERM_BUCKETS), queries, ["doc_id", "chunk_idx"]))


def cited(d: Desk, hits):
    """Hits on chunks with the source and language of the chunk's own document and its whole text."""
    label = F.concat(F.lit("["), F.concat_ws(" · ", "source", "lang"), F.lit("]"))
    return hits.join(d.chunks(), ["doc_id", "chunk_idx"]).select(
        *hits.columns, F.concat_ws(" ", label, "content").alias("citation")
    )


def _cosine_sql(source: str) -> str:
    return f"""
SELECT query_id, vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], q.qv), 12) AS "full"
FROM {source} e, q"""


_ONE_QUERY = """q AS (SELECT min(vec_id) AS query_id, arg_min(embedding, vec_id)::DOUBLE[] AS qv FROM embeddings)"""


def one_query(d: Desk):
    """The first vector of the table."""
    return d.table("embeddings").agg(
        F.min("vec_id").alias("query_id"), F.min_by("embedding", "vec_id").alias("embedding")
    )


@query(
    "vector_search",
    f"""WITH {_ONE_QUERY}, s AS ({_cosine_sql('embeddings')}) {_RANK.format(keys='vec_id', source='s')}""",
)
def vector_search(d: Desk):
    return nearest(d.table("embeddings"), one_query(d), ["vec_id"])


@query(
    "vector_search_filtered",
    f"""WITH q AS (SELECT item_id AS query_id, {terms(squash('"text"'))} AS qv FROM benchmark ORDER BY item_id LIMIT 1),
             c AS (SELECT doc_id, chunk_idx, embedding AS cv, sqrt(list_dot_product(embedding, embedding)) AS cl
                   FROM v_chunkterms WHERE source = 'src3'),
             s AS (SELECT query_id, doc_id, chunk_idx, round(list_dot_product(qv, cv)
                          / (cl * sqrt(list_dot_product(qv, qv))), 12) AS "full" FROM q, c WHERE cl > 0),
             r AS ({_RANK.format(keys='doc_id, chunk_idx', source='s')})
        SELECT r.*, {_CITATION} AS citation FROM r JOIN v_cited USING (doc_id, chunk_idx)""",
)
def vector_search_filtered(d: Desk):
    """Only the chunks of one source are scored for the first benchmark text; hits cite their whole passage."""
    first = d.table("benchmark").orderBy("item_id").limit(1)
    queries = first.select(
        F.col("item_id").alias("query_id"), term_counts(tx.collapse_whitespace(F.col("text"))).alias("embedding")
    )
    chosen = d.chunks("source = 'src3'", TERM_BUCKETS)
    return cited(d, nearest(chosen, queries, ["doc_id", "chunk_idx"]))


@query(
    "vector_search_batch",
    f"""WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id % 20 = 0),
             s AS ({_cosine_sql('embeddings')}) {_RANK.format(keys='vec_id', source='s')}""",
)
def vector_search_batch(d: Desk):
    """Every vector whose id is divisible by 20 against all vectors."""
    return nearest(d.table("embeddings"), asked_vectors(d), ["vec_id"])


def asked_vectors(d: Desk):
    return d.table("embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@query("vector_neighbours")
def vector_neighbours(d: Desk):
    """What the search by hash buckets answers for every vector whose id is divisible by 20; a test holds it against all pairs."""
    return nearest_approx(d.table("embeddings"), asked_vectors(d), ["vec_id"])


@query(
    "vector_search_approx",
    """SELECT 4 * count(*) AS n_exact, true AS recalled FROM embeddings WHERE vec_id % 20 = 0""",
)
def vector_search_approx(d: Desk):
    """Recall of the search by hash buckets against the exact one: nine of ten hits or more."""
    met = recall(vector_search_batch(d), vector_neighbours(d), ["vec_id"])
    return met.select("n_exact", (F.col("n_found") >= 0.9 * F.col("n_exact")).alias("recalled"))


# --- conversations --------------------------------------------------------


@query(
    "memory_search",
    """SELECT thread_id, count(*) FILTER (contains(lower("text"), 'tion')) AS n_hits, count(*) AS n_messages,
              max(version) FILTER (contains(lower("text"), 'tion')) AS last_hit FROM v_turns GROUP BY thread_id""",
)
def memory_search(d: Desk):
    return memory.search_threads(d.turns, "TION")


@query(
    "payload_bytes",
    """SELECT role, count(*) AS n_rows, CAST(sum(octet_length(encode("text"))) AS BIGINT) AS total_bytes,
              CAST(max(octet_length(encode("text"))) AS INTEGER) AS max_bytes FROM v_turns GROUP BY role""",
)
def payload_bytes(d: Desk):
    return memory.payload_sizes(d.turns)


@query(
    "thread_state",
    """SELECT *, count(*) OVER w AS n_messages, CAST(sum(length("text")) OVER w AS BIGINT) AS state_chars FROM v_turns
       WINDOW w AS (PARTITION BY thread_id ORDER BY version)""",
)
def thread_state(d: Desk):
    return memory.thread_versions(d.turns)


@query(
    "thread_pages",
    """SELECT thread_id, version // 64 AS page, min(version) AS first_version, max(version) AS last_version,
              count(*) AS n_messages, string_agg(role || ': ' || "text", chr(10) ORDER BY version) AS messages
       FROM v_turns GROUP BY ALL""",
)
def thread_pages(d: Desk):
    return memory.thread_pages(d.turns)


_LATEST_SQL = """
SELECT thread_id, arg_max(version, version) AS version, arg_max(role, version) AS role, arg_max("text", version) AS "text",
       count(*) AS n_messages, CAST(sum(length("text")) AS BIGINT) AS state_chars FROM v_turns GROUP BY thread_id"""


@query("thread_latest", _LATEST_SQL)
def thread_latest(d: Desk):
    return memory.thread_latest(d.turns)


@query("thread_state_stream", _LATEST_SQL)
def thread_state_stream(d: Desk):
    """Turns arrive as a stream and are appended; a repeated batch replaces itself."""
    path = work_dir(d.spark, "threads")
    stream = stream_table(d.spark, d.base, "conversations").select(
        F.col("conv_id").alias("thread_id"), F.col("turn").alias("version"), "role", "text"
    )

    def append(batch, batch_id: int | str) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/turns/batch={batch_id}")

    append(d.spark.createDataFrame([], stream.schema), "none")
    run_apply(stream, append, f"{path}/checkpoint")
    stored = d.spark.read.schema(stream.schema).parquet(f"{path}/turns").select(*stream.columns)
    return memory.thread_latest(stored.dropDuplicates(["thread_id", "version"]))


@query(
    "thread_prompt",
    """SELECT DISTINCT thread_id, CAST(0 AS BIGINT) AS position, 'system' AS role, 'Answer from the desk''s data.' AS "text" FROM v_turns
       UNION ALL SELECT thread_id, version + 1, role, "text" FROM v_turns""",
)
def thread_prompt(d: Desk):
    return memory.thread_prompts(d.turns, "Answer from the desk's data.")


# --- conversations kept up as they go on ------------------------------------


SAID_FROM = 1_704_067_200  # the time of a thread's first turn, and a minute more for each turn after it


@query("thread_state_incremental", _LATEST_SQL)
def thread_state_incremental(d: Desk):
    """Turns arrive out of order and one arrival comes twice; the stream itself holds each thread's state."""
    path = work_dir(d.spark, "thread-states")
    turns = d.turns.withColumn("said_at", F.timestamp_seconds(F.col("version") * 60 + SAID_FROM))
    arrivals = [turns.where(F.col("version") % 3 == k) for k in (2, 0, 1, 0)]
    table = None
    for part in arrivals:
        part.write.mode("append").parquet(f"{path}/turns")
        stream = memory.thread_states(d.spark.readStream.schema(turns.schema).parquet(f"{path}/turns"), "3650 days")
        table = table or KeyedTable(d.spark, f"{path}/states", stream.schema, ["thread_id"])
        run_apply(stream, table.write, f"{path}/checkpoint", mode="update")
    return table.current().withColumnRenamed("n", "n_messages")


@query(
    "memory_phrase_search",
    r"""SELECT thread_id, count(*) AS n_messages, CAST(sum(n_times) AS BIGINT) AS n_times, max(version) AS last_hit FROM (
         SELECT thread_id, version, len(list_filter(range(1, len(t)), lambda i: t[i] = 'de' AND t[i + 1] = 'la')) AS n_times
         FROM (SELECT thread_id, version, regexp_extract_all(lower("text"), '[^\x09-\x0D\x20.,;:!?]+') AS t FROM v_turns))
       WHERE n_times > 0 GROUP BY thread_id""",
)
def memory_phrase_search(d: Desk):
    """Threads in which two words stand one after the other, from the postings of these words alone."""
    index = Postings(d.spark, work_dir(d.spark, "postings"))
    index.write(d.turns)
    return index.phrase("De la").groupBy("thread_id").agg(
        F.count("*").alias("n_messages"), F.sum("n_times").alias("n_times"), F.max("version").alias("last_hit")
    )


_SENTENCES_SQL = """
SELECT conv_id * 100000 + turn AS turn_id, "text" || CASE conv_id % 4 WHEN 0 THEN ' (show ' || upper(legal_name) || ' ' || sector || '), please'
       WHEN 1 THEN ' what of ' || legal_name || '?' WHEN 2 THEN ' compare ' || lower(ticker) || ', ' || legal_name || ' .' ELSE '' END AS sentence
FROM conversations JOIN v_clients ON client_id = 1 + (conv_id * 8 + turn) % 100"""


def sentences(d: Desk):
    """What is said in every turn, and in most of them the name of a client."""
    asked = d.table("conversations").withColumn("client_id", 1 + (F.col("conv_id") * 8 + F.col("turn")) % 100)
    met = asked.join(d.clients.select("client_id", "legal_name", "ticker", "sector"), "client_id")
    kind = F.col("conv_id") % 4
    more = (
        F.when(kind == 0, F.concat(F.lit(" (show "), F.upper("legal_name"), F.lit(" "), "sector", F.lit("), please")))
        .when(kind == 1, F.concat(F.lit(" what of "), "legal_name", F.lit("?")))
        .when(kind == 2, F.concat(F.lit(" compare "), F.lower("ticker"), F.lit(", "), "legal_name", F.lit(" .")))
        .otherwise("")
    )
    return met.select((F.col("conv_id") * 100000 + F.col("turn")).alias("turn_id"), F.concat("text", more).alias("sentence"))


@query(
    "names_in_text",
    rf"""WITH alias AS (
         SELECT lower(legal_name) AS gram, 'CL-' || client_id AS alias_id FROM v_clients
         UNION ALL SELECT lower(ticker), 'CL-' || client_id FROM v_clients
         UNION ALL SELECT lower(legal_name || ' ' || sector), 'CL-' || client_id || '/' || sector FROM v_clients),
       tok AS (SELECT turn_id, regexp_extract_all(lower(sentence), '[^	-
 .,;:!?()"]+') AS t FROM ({_SENTENCES_SQL})),
       g AS (SELECT turn_id, i, n, array_to_string(t[i:i + n - 1], ' ') AS gram
             FROM (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM tok), (VALUES (1), (2)) l(n) WHERE i + n - 1 <= len(t))
       SELECT turn_id, CAST(i - 1 AS INTEGER) AS position, CAST(n AS INTEGER) AS n_tokens, alias_id FROM g JOIN alias USING (gram)
       QUALIFY row_number() OVER (PARTITION BY turn_id, i ORDER BY n DESC) = 1""",
)
def names_in_text(d: Desk):
    """Every client that a turn names, by name, ticker or name with sector, wherever in the sentence it stands."""
    cid = F.concat(F.lit("CL-"), F.col("client_id"))
    longer = F.struct(F.concat_ws(" ", "legal_name", "sector").alias("alias"), F.concat_ws("/", cid, "sector").alias("alias_id"))
    known = d.clients.select(F.explode(F.array(
        F.struct(F.col("legal_name").alias("alias"), cid.alias("alias_id")), F.struct(F.col("ticker").alias("alias"), cid.alias("alias_id")), longer,
    )).alias("a")).select("a.*")
    return find_names(sentences(d), known, "turn_id", "sentence")
