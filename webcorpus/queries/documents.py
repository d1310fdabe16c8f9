"""From documents to an index: resume, dedup, budget, bulk bodies, populate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from webcorpus import fixtures
from webcorpus.fixtures import table, uuid_of
from webcorpus.functions.keys import COLLECTIONS, object_key
from webcorpus.functions.parsers import render_rfc3339
from webcorpus.operators import bulk, mappings as maps, selection
from webcorpus.operators.ordering import object_index_of, record_idx_of
from webcorpus.plans.populate import populate
from webcorpus.plans.store import Index, Store
from webcorpus.queries import sql
from webcorpus.session import scratch_path
from webcorpus.sources import bodies
from webcorpus.streaming.late import MET, populate_listed_stream
from webcorpus.streaming.stream import populate_stream

CAP = 64 * 1024


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as index candidates: repeated texts share an id."""
    docs = table(spark, sf, "documents")
    placed = fixtures.placed(docs, "doc_id", fixtures.per_object(docs, fixtures.DOCUMENTS_PER_OBJECT))
    return selection.with_position(
        placed.select(
            object_key(F.lit(fixtures.WET_CODE), F.col("object_index")).alias("object_key"),
            "object_index", "record_idx", uuid_of(F.col("text")).alias("doc_id"), F.col("doc_id").alias("number"),
            "text", "lang", "n_chars",
        )
    )


def _index(spark: SparkSession, sf: str) -> DataFrame:
    """Ids the index already holds."""
    return _docs(spark, sf).filter("number % 4 = 1").select("doc_id").distinct()


_HELD = "held AS (SELECT DISTINCT record_id FROM wet WHERE d % 4 = 1)"
_NEW = f"""
{_HELD}, new AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY object_index, record_idx) AS nth FROM wet)
    WHERE nth = 1 AND record_id NOT IN (SELECT record_id FROM held)
)"""


def _progress(spark: SparkSession, sf: str) -> DataFrame:
    """Every third object done, every third half way, the rest untouched."""
    i = F.col("object_index")
    return _docs(spark, sf).select("object_key", "object_index").distinct().filter(i % 3 != 2).select(
        "object_key", F.when(i % 3 == 0, 100).otherwise(50).cast("bigint").alias("next_record_idx"), (i % 3 == 0).alias("done")
    )


def object_state(spark: SparkSession, sf: str) -> DataFrame:
    """D2"""
    objects = _docs(spark, sf).select("object_key").distinct()
    return selection.with_progress(objects, _progress(spark, sf))


OBJECT_STATE = f"""
WITH {sql.DOCUMENTS}
SELECT DISTINCT object_key, CASE object_index % 3 WHEN 0 THEN 100 WHEN 1 THEN 50 ELSE 0 END AS next_record_idx,
    object_index % 3 = 0 AS done FROM wet
"""


def pending_objects(spark: SparkSession, sf: str) -> DataFrame:
    """D3"""
    objects = _docs(spark, sf).select("object_key", "object_index").distinct()
    return selection.pending_objects(objects, _progress(spark, sf))


PENDING_OBJECTS = f"WITH {sql.DOCUMENTS} SELECT DISTINCT object_key, object_index FROM wet WHERE object_index % 3 <> 0"


def resume_from(spark: SparkSession, sf: str) -> DataFrame:
    """G3"""
    return selection.resume_from(_docs(spark, sf).select("object_key", "record_idx", "number"), _progress(spark, sf))


RESUME_FROM = f"""
WITH {sql.DOCUMENTS}
SELECT object_key, record_idx, d AS number FROM wet
WHERE record_idx > CASE object_index % 3 WHEN 0 THEN 100 WHEN 1 THEN 50 ELSE 0 END
"""


def first_by_id(spark: SparkSession, sf: str) -> DataFrame:
    """F3"""
    first = selection.first_by_id(_docs(spark, sf))
    return first.select("doc_id", object_index_of(F.col("pos")).alias("object_index"), record_idx_of(F.col("pos")).alias("record_idx"))


FIRST_BY_ID = f"""
WITH {sql.DOCUMENTS}
SELECT record_id AS doc_id, object_index, record_idx
FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY object_index, record_idx) AS nth FROM wet) WHERE nth = 1
"""


def create_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """What is appended, and the status of every document"""
    written, outcomes = selection.create_documents(_docs(spark, sf), _index(spark, sf))
    texts = written.select("pos", F.md5("text").alias("text_md5"))
    return outcomes.join(texts, "pos", "left").select(
        record_idx_of(F.col("pos")).alias("record_idx"), object_index_of(F.col("pos")).alias("object_index"),
        "doc_id", "outcome", "status", "text_md5",
    )


CREATE_IF_ABSENT = f"""
WITH {sql.DOCUMENTS}, {_NEW}
SELECT wet.record_idx, wet.object_index, wet.record_id AS doc_id,
    CASE WHEN new.d IS NULL THEN 'already_exists' ELSE 'created' END AS outcome,
    CASE WHEN new.d IS NULL THEN 409 ELSE 201 END AS status,
    CASE WHEN new.d IS NOT NULL THEN md5(wet.text) END AS text_md5
FROM wet LEFT JOIN new ON new.d = wet.d
"""


def limit_new(spark: SparkSession, sf: str) -> DataFrame:
    """The first 300 new documents; those the index holds use up nothing"""
    new = selection.new_documents(_docs(spark, sf), _index(spark, sf))
    kept, cut = selection.limit_new(new, 300)
    return kept.select("doc_id", record_idx_of(F.col("pos")).alias("record_idx")).withColumn("cut", F.lit(cut))


LIMIT_NEW = f"""
WITH {sql.DOCUMENTS}, {_NEW},
kept AS (SELECT * FROM new ORDER BY object_index, record_idx LIMIT 300)
SELECT record_id AS doc_id, record_idx,
    (SELECT max((object_index << 31) | record_idx) FROM kept HAVING count(*) = 300) AS cut FROM kept
"""


def _bulk_docs(spark: SparkSession, sf: str) -> DataFrame:
    at = F.timestamp_seconds(F.lit(fixtures.BASE_SECONDS) + F.col("number"))
    doc = F.struct(
        F.col("text"), F.col("lang"), F.when(F.col("number") % 2 == 0, F.col("n_chars")).alias("n_chars"), at.alias("date"),
        F.struct(F.lit("src").alias("name"), F.array("lang").alias("langs")).alias("info"),
    )
    return _docs(spark, sf).select("object_key", "record_idx", "doc_id", doc.alias("doc"))


_PAYLOAD = f"""
payload AS (
    SELECT object_key, object_index, record_idx, record_id,
        '{{"create":{{"_id":"' || record_id || '","_index":"corpus"}}}}' || chr(10) ||
        '{{"date":"' || {sql.instant("d")} || '","info":{{"langs":["' || wet.lang || '"],"name":"src"}},"lang":"' || wet.lang ||
        '","n_chars":' || CASE WHEN d % 2 = 0 THEN n_chars::VARCHAR ELSE 'null' END ||
        ',"text":' || to_json(wet.text)::VARCHAR || '}}' || chr(10) AS payload
    FROM wet JOIN documents ON doc_id = d
)"""


def render_bulk(spark: SparkSession, sf: str) -> DataFrame:
    """I1"""
    rendered = bulk.render_bulk(_bulk_docs(spark, sf), "corpus", cap=32_768)
    return rendered.select("object_key", "record_idx", F.md5("payload").alias("payload_md5"), "n_bytes", "reject_reason")


RENDER_BULK = f"""
WITH {sql.DOCUMENTS}, {_PAYLOAD}
SELECT object_key, record_idx, md5(payload) AS payload_md5, strlen(payload) AS n_bytes,
    CASE WHEN strlen(payload) > 32768 THEN 'oversize' END AS reject_reason
FROM payload
"""


def pack_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Bodies of at most 64 KiB, packed over several segments per object"""
    return bulk.pack_batches(bulk.render_bulk(_bulk_docs(spark, sf), "corpus"), cap=CAP, segment=16)


# Greedy packing as it is defined, one document after the other.
PACK_BATCHES = f"""
WITH RECURSIVE {sql.DOCUMENTS}, {_PAYLOAD},
sized AS (
    SELECT object_key, record_idx, strlen(payload) AS n,
        row_number() OVER (PARTITION BY object_key ORDER BY record_idx) AS k
    FROM payload WHERE strlen(payload) <= {CAP}
),
packed(object_key, record_idx, k, batch_no, fill) AS (
    SELECT object_key, record_idx, k, 0::BIGINT, n FROM sized WHERE k = 1
    UNION ALL
    SELECT s.object_key, s.record_idx, s.k, CASE WHEN fill + n > {CAP} THEN batch_no + 1 ELSE batch_no END,
        CASE WHEN fill + n > {CAP} THEN n ELSE fill + n END
    FROM packed p JOIN sized s ON s.object_key = p.object_key AND s.k = p.k + 1
)
SELECT object_key, record_idx, batch_no FROM packed
"""


def bulk_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """The bodies in few files, read back by their index"""
    path = scratch_path(spark, "bodies")
    bodies.store_bodies(bulk.render_bulk(_bulk_docs(spark, sf), "corpus"), path, CAP, 16)
    body = F.col("body").cast("string")
    return bodies.read_bodies(spark, path).groupBy("object_key", "batch_no").agg(
        F.sum(F.size(F.split(body, '\\{"create":')) - 1).cast("bigint").alias("documents"), F.sum(F.octet_length("body")).cast("bigint").alias("n_bytes")
    )


BULK_BODIES = PACK_BATCHES.replace(
    "SELECT object_key, record_idx, batch_no FROM packed",
    "SELECT packed.object_key, batch_no, count(*) AS documents, sum(n)::BIGINT AS n_bytes FROM packed "
    "JOIN sized USING (object_key, record_idx) GROUP BY ALL",
)


SMALL_CAP = 4096


def bulk_oversize(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that no body can hold come back, the others are in the bodies"""
    path = scratch_path(spark, "bodies")
    rejects = bodies.store_bodies(bulk.render_bulk(_bulk_docs(spark, sf), "corpus"), path, SMALL_CAP, 16)
    lines = bodies.read_bodies(spark, path).select("object_key", F.explode(F.split(F.col("body").cast("string"), "\n")).alias("line"))
    held = lines.filter(F.col("line").startswith('{"create":')).groupBy("object_key").agg(F.count("*").alias("held"))
    refused = rejects.groupBy("object_key").agg(F.count("*").alias("refused"), F.max("n_bytes").alias("largest"))
    return held.join(refused, "object_key", "full").select(
        "object_key", F.coalesce("held", F.lit(0)).cast("bigint").alias("held"), F.coalesce("refused", F.lit(0)).cast("bigint").alias("refused"), "largest"
    )


BULK_OVERSIZE = f"""
WITH {sql.DOCUMENTS}, {_PAYLOAD}, sized AS (SELECT object_key, strlen(payload) AS n FROM payload)
SELECT object_key, count(*) FILTER (n <= {SMALL_CAP}) AS held, count(*) FILTER (n > {SMALL_CAP}) AS refused,
    max(n) FILTER (n > {SMALL_CAP}) AS largest
FROM sized GROUP BY object_key
"""


def progress_from_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Replies to the bodies, item by item, and what they leave to be sent again"""
    rendered = bulk.render_bulk(_bulk_docs(spark, sf), "corpus")
    packed = bulk.pack_batches(rendered, CAP, 16)
    numbers = _docs(spark, sf).select("object_key", "record_idx", "number")
    sent = packed.join(numbers, ["object_key", "record_idx"])
    n = F.col("number")
    error = (
        F.when(n % 7 == 1, '{"type":"version_conflict_engine_exception"}').when(n % 31 == 2, '{"type":"mapper_parsing_exception"}')
        .when(n % 97 == 3, '{"type":"es_rejected_execution_exception"}')
    )
    status = F.when(n % 7 == 1, 409).when(n % 31 == 2, 400).when(n % 97 == 3, 429).otherwise(201)
    item = F.concat(F.lit('{"create":{"status":'), status.cast("string"), F.coalesce(F.concat(F.lit(',"error":'), error), F.lit("")), F.lit("}}"))
    # A body is bounded by its bytes. The third body of every object gets no reply.
    answers = sent.groupBy("object_key", "batch_no").agg(F.array_sort(F.collect_list(F.struct("record_idx", item.alias("item")))).alias("items"))
    reply = F.concat(F.lit('{"errors":true,"items":['), F.array_join(F.transform("items", lambda x: x["item"]), ","), F.lit("]}"))
    replies = answers.filter("batch_no <> 2").select("object_key", "batch_no", reply.alias("reply"))
    rejected = rendered.filter(F.col("n_bytes") > CAP).select("object_key", "record_idx")
    progress, again = bulk.reply_progress(bulk.reply_outcomes(packed, replies), rejected)
    return progress.join(again.groupBy("object_key").agg(F.count("*").alias("again")), "object_key", "left").withColumn(
        "again", F.coalesce("again", F.lit(0).cast("bigint"))
    )


PROGRESS_FROM_REPLIES = PACK_BATCHES.replace("SELECT object_key, record_idx, batch_no FROM packed", f"""
, answered AS (
    SELECT s.object_key, s.record_idx,
        CASE WHEN s.n > {CAP} THEN 'rejected' WHEN batch_no = 2 THEN 'again' WHEN d % 7 = 1 THEN 'already_exists'
            WHEN d % 31 = 2 THEN 'failed' WHEN d % 97 = 3 THEN 'again' ELSE 'created' END AS outcome
    FROM (SELECT object_key, record_idx, d, strlen(payload) AS n FROM payload JOIN wet USING (object_key, record_idx)) s
    LEFT JOIN packed p USING (object_key, record_idx)
), stopped AS (
    SELECT *, coalesce(record_idx < min(record_idx) FILTER (outcome = 'again') OVER (PARTITION BY object_key), true) AS used FROM answered
)
SELECT object_key, coalesce(max(record_idx) FILTER (used), 0) AS next_record_idx, bool_and(used) AS done,
    count(*) FILTER (used AND outcome = 'created') AS created, count(*) FILTER (used AND outcome = 'already_exists') AS already_exists,
    count(*) FILTER (used AND outcome = 'failed') AS failed, count(*) FILTER (used AND outcome = 'rejected') AS rejected,
    count(*) FILTER (outcome = 'again') AS again
FROM stopped GROUP BY object_key
""")


def _replies(spark: SparkSession, sf: str) -> DataFrame:
    """Events as items of bulk replies, 20 to a reply; every fifth reply reports no errors."""
    kind = F.col("event_type")
    ident = F.col("event_id").cast("string")
    error = (
        F.when(kind == "error", F.lit('{"type":"mapper_parsing_exception","reason":"bad"}'))
        .when(kind == "click", F.lit('{"type":"version_conflict_engine_exception","reason":"exists"}'))
    )
    status = F.when(kind == "error", 400).when(kind == "click", 409).otherwise(201)
    item = F.concat(
        F.lit('{"create":{"_id":"'), ident, F.lit('","_index":"corpus","status":'), status.cast("string"),
        F.coalesce(F.concat(F.lit(',"error":'), error), F.lit("")), F.lit("}}"),
    )
    events = table(spark, sf, "events").withColumn("bulk", F.floor(F.col("event_id") / 20))
    items = F.array_join(F.collect_list("item"), ",")
    clean = F.col("bulk") % 5 == 0
    # At most 20 items to a reply, by construction.
    return (
        events.withColumn("item", F.when(clean, F.regexp_replace(item, ',"error":.*', "}}")).otherwise(item))
        .groupBy("bulk").agg(items.alias("items"))
        .select("bulk", F.concat(F.lit('{"took":3,"errors":'), (~clean).cast("string"), F.lit(',"items":['), "items", F.lit("]}")).alias("reply"))
    )


def bulk_response_rows(spark: SparkSession, sf: str) -> DataFrame:
    """E6"""
    return bulk.bulk_response_rows(_replies(spark, sf))


_ITEMS = """
item AS (
    SELECT event_id // 20 AS bulk, event_id::VARCHAR AS doc_id, 'corpus' AS index_name,
        CASE event_type WHEN 'error' THEN 400 WHEN 'click' THEN 409 ELSE 201 END AS status,
        CASE WHEN (event_id // 20) % 5 = 0 THEN NULL WHEN event_type = 'error' THEN 'mapper_parsing_exception'
            WHEN event_type = 'click' THEN 'version_conflict_engine_exception' END AS error_type
    FROM events
), outcome AS (
    SELECT *, CASE error_type WHEN 'mapper_parsing_exception' THEN 'failed'
        WHEN 'version_conflict_engine_exception' THEN 'already_exists' ELSE 'created' END AS outcome FROM item
)"""
BULK_RESPONSE_ROWS = f"WITH {_ITEMS} SELECT * FROM outcome"


def outcome_tally(spark: SparkSession, sf: str) -> DataFrame:
    """E2"""
    return bulk.tally_outcomes(bulk.bulk_response_rows(_replies(spark, sf)), ["bulk"])


OUTCOME_TALLY = f"""
WITH {_ITEMS}
SELECT bulk, count(*) FILTER (outcome = 'created') AS created, count(*) FILTER (outcome = 'already_exists') AS already_exists,
    count(*) FILTER (outcome = 'failed') AS failed
FROM outcome GROUP BY bulk
"""

TURN_SCHEMA = StructType([StructField("speaker", StringType()), StructField("words", StringType())])


def _turns(rows: DataFrame) -> DataFrame:
    doc = F.struct(F.upper("role").alias("speaker"), F.col("text").alias("words"))
    ok = F.length("text") >= 100
    return rows.select(
        F.concat_ws("-", "conv_id", "turn").alias("doc_id"),
        F.when(ok, doc).alias("doc"),
        F.when(~ok, "too short").alias("reject_reason"),
    )


def user_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """L1: a mapping of the user's own"""
    mine = maps.Mapping("turns", frozenset(COLLECTIONS.values()), TURN_SCHEMA, _turns)
    mapped = maps.conform(mine.transform(table(spark, sf, "conversations")), mine.schema)
    accepted, rejected = maps.split_rejects(mapped.withColumn("record_idx", F.lit(1)))
    return (
        accepted.groupBy("doc.speaker").agg(F.count("*").alias("turns"), F.sum(F.length("doc.words")).alias("chars"))
        .unionByName(
            rejected.groupBy("reject_reason").agg(F.count("*").alias("turns"))
            .select(F.col("reject_reason").alias("speaker"), "turns", F.lit(0).cast("bigint").alias("chars"))
        )
    )


USER_MAPPING = """
SELECT upper(role) AS speaker, count(*) AS turns, sum(length(text))::BIGINT AS chars
FROM conversations WHERE length(text) >= 100 GROUP BY 1
UNION ALL
SELECT 'too short', count(*), 0 FROM conversations WHERE length(text) < 100 HAVING count(*) > 0
"""


def _fresh_index(spark: SparkSession, name: str) -> Index:
    store = Store(spark, scratch_path(spark, name))
    return store.open(store.create_index("cc-wet2024", "cc-wet", "best_compression"))


def _stored(index: Index) -> DataFrame:
    return index.documents().select(
        "object_key", "record_idx", "doc_id", F.col("run_id").cast("bigint").alias("run_id"),
        F.col("doc.content_length").alias("content_length"), render_rfc3339(F.col("doc.date")).alias("date"),
        F.md5(F.encode("doc.content", "ISO-8859-1")).alias("content_md5"),
    )


def populate_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """All of it: a run with a budget of 250 new documents, then the rest"""
    index = _fresh_index(spark, "populate")
    objects = fixtures.list_written(spark, fixtures.archives(spark, sf, "wet"), fixtures.WET_CODE)
    populate(index, objects, n=250)
    populate(index, objects)
    return _stored(index).withColumn("run_id", F.least("run_id", F.lit(2)))


_STORED = """
    object_key, record_idx, record_id AS doc_id, {run} AS run_id, strlen(text) AS content_length,
    {date} AS date, md5(text) AS content_md5
FROM (SELECT *, row_number() OVER (ORDER BY object_index, record_idx) AS place FROM (
    SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY object_index, record_idx) AS nth FROM wet) WHERE nth = 1)
"""
POPULATE_END_TO_END = f"""
WITH {sql.DOCUMENTS}
SELECT {_STORED.format(run="CASE WHEN place <= 250 THEN 1::BIGINT ELSE 2 END", date=sql.instant("d"))}
"""


def _broken_archives(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """Of four archives one is whole, one isn't there, one has a record without a length in third place,
    and one ends inside its last record."""
    rows = fixtures.wet_rows(table(spark, sf, "documents"))
    last = rows.groupBy("object_index").agg(F.max("record_idx").alias("last"))
    kind = F.col("object_index") % 4
    no_length = F.regexp_replace("value", "\r\nContent-Length: [0-9]+\r\n", "\r\n")
    cut = F.regexp_replace("value", "\r\nContent-Length: ([0-9]+)\r\n", "\r\nContent-Length: 1$1\r\n")
    value = F.when((kind == 2) & (F.col("record_idx") == 3), no_length).when((kind == 3) & (F.col("record_idx") == F.col("last")), cut).otherwise(F.col("value"))
    path = scratch_path(spark, "broken")
    fixtures.write_archives(rows.join(last, "object_index").filter(kind != 1).select("object_index", "record_idx", value.alias("value")), path)
    there = fixtures.list_written(spark, path, fixtures.WET_CODE)
    gone = last.filter(kind == 1).select(
        object_key(F.lit(fixtures.WET_CODE), F.col("object_index")).alias("object_key"), "object_index",
        F.concat(F.lit(path), F.lit("/object_index="), F.col("object_index").cast("string"), F.lit("/part.txt.gz")).alias("path"),
    )
    # Written, so that the table isn't read again for every window.
    listing = scratch_path(spark, "broken-listing")
    there.unionByName(gone).write.parquet(listing)
    return path, spark.read.parquet(listing)


def populate_failures(spark: SparkSession, sf: str) -> DataFrame:
    """A5, E5: damaged and missing objects hold up no other; three calls give each reject once"""
    index = _fresh_index(spark, "failures")
    _, objects = _broken_archives(spark, sf)
    populate(index, objects, window=3)
    populate(index, objects)
    populate(index, objects, retry_failed=True)
    rejects = index.rejects().groupBy("object_key").agg(F.count("*").alias("rejects"), F.max("reject_reason").alias("reason"))
    counts = index.documents().groupBy("object_key").agg(F.count("*").alias("documents"))
    return (
        index.states().join(rejects, "object_key", "left").join(counts, "object_key", "left")
        .select(
            "object_key", "next_record_idx", "done", "created", "already_exists", "rejected", "error", "reason",
            F.coalesce("rejects", F.lit(0)).cast("bigint").alias("rejects"), F.coalesce("documents", F.lit(0)).cast("bigint").alias("documents"),
        )
    )


POPULATE_FAILURES = f"""
WITH {sql.DOCUMENTS}, placed AS (
    SELECT *, object_index % 4 AS kind, max(record_idx) OVER (PARTITION BY object_index) AS last FROM wet
), readable AS (
    SELECT *, kind = 0 OR (kind = 2 AND record_idx < 3) OR (kind = 3 AND record_idx < last) AS good FROM placed
), counted AS (
    SELECT *, good AND row_number() OVER (PARTITION BY record_id, good ORDER BY object_index, record_idx) = 1 AS created FROM readable
), object AS (
    SELECT object_key, kind, max(last) AS last, coalesce(max(record_idx) FILTER (good), 0) AS next_record_idx,
        count(*) FILTER (created) AS created, count(*) FILTER (good AND NOT created) AS already_exists
    FROM counted GROUP BY object_key, kind
), told AS (
    SELECT *, CASE kind WHEN 1 THEN 'parse: missing_object' WHEN 2 THEN CASE WHEN last >= 3 THEN 'parse: missing_content_length' END
        WHEN 3 THEN 'parse: truncated' END AS error FROM object
)
SELECT object_key, next_record_idx, error IS NULL AS done, created, already_exists, CASE WHEN error IS NULL THEN 0 ELSE 1 END::BIGINT AS rejected,
    error, error AS reason, CASE WHEN error IS NULL THEN 0 ELSE 1 END::BIGINT AS rejects, created AS documents
FROM told
"""


def populate_repeated_index(spark: SparkSession, sf: str) -> DataFrame:
    """Objects that share an index, on both sides of a window's border"""
    index = _fresh_index(spark, "repeated")
    objects = fixtures.list_written(spark, fixtures.archives(spark, sf, "wet"), fixtures.WET_CODE)
    populate(index, objects.withColumn("object_index", F.floor(F.col("object_index") / 4).cast("bigint")), window=3)
    return index.documents().select("doc_id", "object_key", "object_index", "record_idx")


POPULATE_REPEATED_INDEX = f"""
WITH {sql.DOCUMENTS}
SELECT record_id AS doc_id, object_key, object_index // 4 AS object_index, record_idx
FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY object_index, record_idx) AS nth FROM wet) WHERE nth = 1
"""


def stream_populate(spark: SparkSession, sf: str) -> DataFrame:
    """K1, K2: the archives as a stream in two micro-batches, and once more from the start"""
    index = _fresh_index(spark, "stream")
    source = fixtures.archives(spark, sf, "wet")
    objects = fixtures.list_written(spark, source, fixtures.WET_CODE)
    files = max(1, -(-objects.count() // 2))
    for _ in range(2):
        populate_stream(index, source, objects, scratch_path(spark, "offsets"), max_files=files).awaitTermination()
    return _stored(index).select("doc_id", "content_length", "content_md5")


POPULATE_STREAM = f"""
WITH {sql.DOCUMENTS} SELECT DISTINCT record_id AS doc_id, strlen(text) AS content_length, md5(text) AS content_md5 FROM wet
"""

def late_listing(spark: SparkSession, sf: str) -> DataFrame:
    """K1: the files first, then their listing in two parts, as a stream of its own"""
    index = _fresh_index(spark, "late")
    source = fixtures.archives(spark, sf, "wet")
    objects = fixtures.list_written(spark, source, fixtures.WET_CODE)
    listed, offsets = scratch_path(spark, "listing"), scratch_path(spark, "offsets")
    odd = F.col("object_index") % 2 == 1
    for part in (objects.limit(0), objects.filter(odd), objects.filter(~odd)):
        part.coalesce(1).write.mode("append").parquet(listed)
        stream = spark.readStream.schema(MET).parquet(listed)
        populate_listed_stream(index, source, stream, offsets).awaitTermination()
    return _stored(index).select("doc_id", "content_length", "content_md5")


QUERIES = {
    "object_state": (object_state, OBJECT_STATE),
    "pending_objects": (pending_objects, PENDING_OBJECTS),
    "resume_from": (resume_from, RESUME_FROM),
    "first_by_id": (first_by_id, FIRST_BY_ID),
    "create_if_absent": (create_if_absent, CREATE_IF_ABSENT),
    "limit_new": (limit_new, LIMIT_NEW),
    "render_bulk": (render_bulk, RENDER_BULK),
    "pack_batches": (pack_batches, PACK_BATCHES),
    "bulk_bodies": (bulk_bodies, BULK_BODIES),
    "bulk_oversize": (bulk_oversize, BULK_OVERSIZE),
    "progress_from_replies": (progress_from_replies, PROGRESS_FROM_REPLIES),
    "bulk_response_rows": (bulk_response_rows, BULK_RESPONSE_ROWS),
    "outcome_tally": (outcome_tally, OUTCOME_TALLY),
    "user_mapping": (user_mapping, USER_MAPPING),
    "populate_end_to_end": (populate_end_to_end, POPULATE_END_TO_END),
    "populate_failures": (populate_failures, POPULATE_FAILURES),
    "populate_repeated_index": (populate_repeated_index, POPULATE_REPEATED_INDEX),
    "populate_stream": (stream_populate, POPULATE_STREAM),
    "populate_late_listing": (late_listing, POPULATE_STREAM),
}
