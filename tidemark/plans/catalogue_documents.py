"""Queries over nested and quoted documents, versions, parts, bundles, routes and sets."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import content as ct
from tidemark.operators import coverage as cv
from tidemark.operators import jobs as jb
from tidemark.operators import proofs, scan, sets
from tidemark.operators import quality as qa
from tidemark.plans.registry import register, table
from tidemark.session import settle, shared_folder
from tidemark.sources import readers, writers


# --- nested documents ---------------------------------------------------------------
@register(
    "nested_fields",
    r"""WITH d AS (SELECT event_id, json_object('event', json_object('id', event_id, 'kind', event_type, 'props', props::JSON),
    'tags', json_array(event_type, json_object('user', user_id::VARCHAR), json_array())) AS j FROM events),
t AS (SELECT event_id, key, type, json_extract_string(j, fullkey) AS text,
    regexp_replace(regexp_replace(fullkey, '\.[a-z]+', '.*', 'g'), '\[\d+\]', '[]', 'g') AS location,
    regexp_matches(key, '^[a-z]') AS named FROM d, json_tree(j))
SELECT event_id, location, key AS field, NULL::VARCHAR AS text FROM t WHERE named
UNION ALL SELECT event_id, location, NULL, text FROM t WHERE type = 'VARCHAR'""",
)
def nested_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Every member name and every string of nested documents made of the events."""
    event = F.struct(
        F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.parse_json("props").alias("props")
    )
    tags = F.to_variant_object(F.array(F.col("user_id").cast("string")))
    user = F.to_variant_object(F.struct(F.col("user_id").cast("string").alias("user")))
    none = F.to_variant_object(F.filter(F.array(F.lit("")), lambda x: x != ""))
    kind = F.parse_json(F.to_json(F.array("event_type"))).alias("k")
    tags = F.array(F.variant_get(kind, "$[0]", "variant"), user, none)
    docs = table(spark, folder, "events").select(
        "event_id", F.to_variant_object(F.struct(event.alias("event"), tags.alias("tags"))).alias("v")
    )
    return scan.flatten_documents(docs, "event_id", "v").select("event_id", "location", "field", "text")


@register(
    "forbidden_names",
    """SELECT event_type, 'credential field' AS category, count(*) AS finding_count FROM events WHERE event_type IN ('click', 'error') GROUP BY 1
UNION ALL SELECT event_type, 'personal/account identifier field', count(*) FROM events WHERE event_type NOT IN ('click', 'error') GROUP BY 1""",
)
def forbidden_names(spark: SparkSession, folder: str) -> DataFrame:
    """Findings in documents whose member names depend on the kind of the event."""
    secret = F.to_json(F.struct(F.array(F.struct(F.lit("x").alias("apiKey"))).alias("list"), F.lit(1).alias("close")))
    person = F.to_json(F.struct(F.struct(F.lit("x").alias("phone-number")).alias("who"), F.lit(1).alias("close")))
    text = F.when(F.col("event_type").isin("click", "error"), secret).otherwise(person)
    docs = table(spark, folder, "events").select("event_id", "event_type", F.parse_json(text).alias("v"))
    found = scan.scan_documents(docs, "event_id", "v").join(docs.select("event_id", "event_type"), "event_id")
    return found.groupBy("event_type", "category").agg(F.count(F.lit(1)).alias("finding_count"))


# --- quoted texts -------------------------------------------------------------------
REQUIRED = [["License", "CC BY"], ["MIT", "Apache", "4.0"]]
FORBIDDEN = ["v. 2.0"]


def _quoted(text: Column, times: Column) -> Column:
    """JSON that holds JSON, ``times`` deep; escapes that grow by a constant for each level."""
    plain = F.regexp_replace(F.regexp_replace(text, r"\\", r"\\u005c"), "\n", r"\\u000a")
    once = lambda t: F.concat(
        F.lit('["'), F.replace(F.replace(t, F.lit("\\"), F.lit("\\u005c")), F.lit('"'), F.lit("\\u0022")), F.lit('"]')
    )
    first = F.concat(F.lit('["'), F.replace(plain, F.lit('"'), F.lit("\\u0022")), F.lit('"]'))
    return F.aggregate(F.sequence(F.lit(1), times), first, lambda t, i: F.when(i == 1, t).otherwise(once(t)))


@register(
    "semantic_gate",
    r"""WITH k AS (SELECT doc_id, text, lower(regexp_replace(text, '[^\p{L}\p{M}\p{N}]+', '', 'g')) AS s FROM documents)
SELECT doc_id, CASE WHEN text IS NULL OR trim(text) = '' THEN 'unverifiable'
  WHEN (contains(s, 'license') OR contains(s, 'ccby')) AND (contains(s, 'mit') OR contains(s, 'apache') OR contains(s, '40'))
    AND NOT contains(s, 'v20') THEN 'ok' ELSE 'mismatch' END AS status FROM k""",
)
def semantic_gate(spark: SparkSession, folder: str) -> DataFrame:
    """The gate on documents that are quoted 1 to 30 times."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    quoted = docs.select("doc_id", F.when(F.col("text") != "", _quoted(F.col("text"), F.col("doc_id") % 30 + 1)).alias("text"))
    return ct.semantic_gate(quoted, "text", REQUIRED, FORBIDDEN).select("doc_id", "status")


# --- versions -----------------------------------------------------------------------
_SQL_VERSION = r"""list_transform(regexp_split_to_array(lower({v}), '[._+-]'), lambda p: CASE WHEN regexp_full_match(p, '\d+')
  THEN {{'kind': 1, 'n': p::HUGEINT, 't': ''}} ELSE {{'kind': 0, 'n': 0::HUGEINT, 't': p}} END)"""


@register(
    "version_choice",
    f"""WITH m AS (SELECT p_partkey, p_type, p_size // 10 AS day, replace(p_brand, '#', '.') || '-' || p_size AS parser,
    replace(p_name, ' ', '.') || '.' || repeat('0', (p_partkey % 3)::INTEGER) || (p_partkey * 37 % 1000) || repeat('.0', (p_partkey % 2)::INTEGER) AS rules FROM part)
SELECT p_partkey, p_type, day, parser, rules FROM m
QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY day DESC, {_SQL_VERSION.format(v="parser")} DESC, {_SQL_VERSION.format(v="rules")} DESC, p_partkey DESC) = 1""",
)
def version_choice(spark: SparkSession, folder: str) -> DataFrame:
    """Of every type the manifest of the newest day and the greatest versions."""
    manifests = table(spark, folder, "part").select(
        "p_partkey",
        "p_type",
        F.floor(F.col("p_size") / 10).cast("int").alias("day"),
        F.concat(F.replace("p_brand", F.lit("#"), F.lit(".")), F.lit("-"), F.col("p_size")).alias("parser"),
        F.concat(
            F.replace("p_name", F.lit(" "), F.lit(".")),
            F.lit("."),
            F.repeat(F.lit("0"), (F.col("p_partkey") % 3).cast("int")),
            (F.col("p_partkey") * 37 % 1000).cast("string"),
            F.repeat(F.lit(".0"), (F.col("p_partkey") % 2).cast("int")),
        ).alias("rules"),
    )
    return cv.best_version(manifests, ["p_type"], "day", ["parser", "rules"], "p_partkey")


# --- split exports ------------------------------------------------------------------
#: Fixed values of the queries: bytes of a part.
PART_BYTES = 50_000


def _queue(spark: SparkSession, folder: str) -> DataFrame:
    priority = F.concat(F.lit("P"), F.least(F.lit(2), F.col("c_custkey") % 40).cast("string"))
    return table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment", priority.alias("priority"))


_SQL_QUEUE = """q AS (SELECT c_custkey, c_name, c_mktsegment, 'P' || least(2, c_custkey % 40) AS priority FROM customer),
l AS (SELECT *, strlen(json_object('c_custkey', c_custkey, 'c_name', c_name, 'c_mktsegment', c_mktsegment, 'priority', priority)) + 1 AS line_bytes FROM q)"""


@register(
    "byte_buckets",
    f"""WITH {_SQL_QUEUE},
s AS (SELECT *, sum(line_bytes) OVER (ORDER BY c_custkey) - line_bytes AS before, max(line_bytes) OVER () AS largest FROM l)
SELECT (before // ({PART_BYTES} - largest))::BIGINT + 1 AS part, count(*) AS record_count, sum(line_bytes)::BIGINT AS byte_size FROM s GROUP BY 1""",
)
def byte_buckets(spark: SparkSession, folder: str) -> DataFrame:
    parts = writers.size_bounded_parts(_queue(spark, folder), ["c_custkey"], PART_BYTES)
    return writers.part_summary(parts).withColumn("byte_size", F.col("byte_size").cast("long"))


@register(
    "split_reassembly",
    """WITH n AS (SELECT count(*) AS n, max(c_custkey) AS last FROM customer)
SELECT 'whole' AS parts_of, n AS source_count, n AS part_count, true AS reassembles FROM n
UNION ALL SELECT 'one_lost', n, n - 1, false FROM n
UNION ALL SELECT 'one_twice', n, n + 1, false FROM n
UNION ALL SELECT 'one_changed', n, n, false FROM n""",
)
def split_reassembly(spark: SparkSession, folder: str) -> DataFrame:
    """The proof on the parts of the queue, and on parts that were tampered with."""
    queue, columns = _queue(spark, folder), ["c_custkey", "c_name", "c_mktsegment", "priority"]
    parts = settle(writers.size_bounded_parts(queue, ["c_custkey"], PART_BYTES))
    last = F.col("c_custkey") == queue.agg(F.max("c_custkey")).first()[0]
    tampered = {
        "whole": parts,
        "one_lost": parts.where(~last),
        "one_twice": parts.unionByName(parts.where(last)),
        "one_changed": parts.withColumn("priority", F.when(last, F.lit("P9")).otherwise(F.col("priority"))),
    }
    out = None
    for name, rows in tampered.items():
        told = proofs.reassembly(rows, queue, columns).select(F.lit(name).alias("parts_of"), "*")
        out = told if out is None else out.unionByName(told)
    return out


@register(
    "priority_summary",
    f"""WITH {_SQL_QUEUE}, s AS (SELECT p AS priority, count(line_bytes) AS record_count, coalesce(sum(line_bytes), 0)::BIGINT AS byte_size
  FROM (VALUES ('P0'), ('P1')) v(p) LEFT JOIN l ON l.priority = p GROUP BY 1)
SELECT *, (sum(byte_size) OVER ())::BIGINT AS summary_bytes, sum(byte_size) OVER () <= {PART_BYTES} AS fits FROM s""",
)
def priority_summary(spark: SparkSession, folder: str) -> DataFrame:
    queue = _queue(spark, folder)
    return proofs.priority_summary(queue.withColumn("line_bytes", writers.json_line_bytes(queue).cast("long")), PART_BYTES)


@register(
    "table_digests",
    """WITH r AS (SELECT source, sha256(concat(strlen(doc_id::VARCHAR) || ':' || doc_id, coalesce(strlen(lang) || ':' || lang, '-'),
    coalesce(strlen(text) || ':' || text, '-'))) AS h FROM documents)
SELECT source, count(*) AS rows, sum(('0x' || h[1:12])::BIGINT)::DECIMAL(38,0) AS low, sum(('0x' || h[13:24])::BIGINT)::DECIMAL(38,0) AS high FROM r GROUP BY 1""",
)
def table_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Order-free digests of the documents of each source, over whole texts."""
    return proofs.table_digests(table(spark, folder, "documents"), ["doc_id", "lang", "text"], ["source"])


# --- manifests ----------------------------------------------------------------------
def _stored(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """The queue as JSON lines in the shared folder, in parts, and the manifest of its files."""
    root = f"{shared_folder(spark)}/bundle-{uuid.uuid4().hex}"
    writers.write_shards(_queue(spark, folder), f"{root}/queue", "c_name")
    return root, settle(writers.table_manifest(spark, root, "queue", folder="queue"))


@register(
    "file_manifest",
    """SELECT 'queue' AS table_name, 'ok' AS status, left(sha256(c_name), 1) AS shard, true AS found, sum(strlen(json_object('c_custkey', c_custkey,
  'c_name', c_name, 'c_mktsegment', c_mktsegment, 'priority', 'P' || least(2, c_custkey % 40))) + 1)::BIGINT AS byte_size FROM customer GROUP BY ALL""",
)
def file_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Status and bytes of the files of a written table, by shard; every file is checked against its entry."""
    root, manifest = _stored(spark, folder)
    checked = readers.manifest_check(manifest, readers.file_digests(spark, root, "part-*"), root)
    shard = F.regexp_extract("file", "shard=([0-9a-f])/", 1).alias("shard")
    rows = manifest.join(checked, ["table_name", "file"]).groupBy("table_name", "status", shard)
    return rows.agg(F.lit(True).alias("found"), F.sum("byte_size").cast("long").alias("byte_size"))


@register(
    "roundtrip_sources",
    "SELECT c_custkey, c_name, c_mktsegment, 'P' || least(2, c_custkey % 40) AS priority FROM customer",
)
def roundtrip_sources(spark: SparkSession, folder: str) -> DataFrame:
    """A table that was written, listed in a manifest, verified and read back."""
    root, manifest = _stored(spark, folder)
    schema = "c_custkey long, c_name string, c_mktsegment string, priority string"
    rows, _ = readers.read_table(spark, manifest, root, "queue", schema, "part-*")
    return rows


# --- bundles and routes -------------------------------------------------------------
@register(
    "bundle_ids",
    """SELECT o_custkey, left(sha256('market' || chr(0) || '1.2.0' || chr(0) || string_agg(DISTINCT m, chr(0) ORDER BY m)), 20) AS bundle_id
FROM (SELECT o_custkey, o_orderpriority || '/' || (o_orderkey % 50) AS m FROM orders) GROUP BY 1""",
)
def bundle_ids(spark: SparkSession, folder: str) -> DataFrame:
    member = F.concat("o_orderpriority", F.lit("/"), F.col("o_orderkey") % 50)
    rows = table(spark, folder, "orders").select("o_custkey", member.alias("member"))
    return jb.bundle_id(rows, ["o_custkey"], ["market", "1.2.0"], "member")


_SQL_RULES = """r AS (SELECT DISTINCT 'prefix' AS kind, string_split(p_name, ' ')[1] || ' ' AS rule, 'colour:' || string_split(p_name, ' ')[1] AS route FROM part
  UNION SELECT 'prefix', left(p_name, 6), 'six:' || left(p_name, 6) FROM part WHERE p_size > 25 AND p_name < 'm'
  UNION SELECT 'exact', p_name, 'part:' || p_name FROM part WHERE p_size = 7)"""


@register(
    "prefix_routes",
    f"""WITH {_SQL_RULES},
h AS (SELECT p_partkey, p_name, count(rule) FILTER (WHERE kind = 'exact') AS e, count(rule) FILTER (WHERE kind = 'prefix') AS p,
  min(route) FILTER (WHERE kind = 'exact') AS by_e, min(route) FILTER (WHERE kind = 'prefix') AS by_p
  FROM part LEFT JOIN r ON (kind = 'exact' AND p_name = rule) OR (kind = 'prefix' AND starts_with(p_name, rule)) GROUP BY 1, 2)
SELECT p_partkey, p_name, CASE WHEN e > 0 THEN by_e WHEN p = 1 THEN by_p END AS route,
  CASE WHEN e = 0 AND p > 1 THEN 'matches_multiple_prefixes' END AS route_error FROM h""",
)
def prefix_routes(spark: SparkSession, folder: str) -> DataFrame:
    """Part names routed by rules that are made of the parts themselves."""
    part = table(spark, folder, "part")
    first, six = F.substring_index("p_name", " ", 1), F.left("p_name", F.lit(6))

    def rules(kind: str, rule: Column, tag: str, route: Column) -> tuple[Column, ...]:
        return F.lit(kind).alias("kind"), rule.alias("rule"), F.concat(F.lit(tag), route).alias("route")

    made = part.select(*rules("prefix", F.concat(first, F.lit(" ")), "colour:", first))
    made = made.unionByName(part.where("p_size > 25 AND p_name < 'm'").select(*rules("prefix", six, "six:", six)))
    made = made.unionByName(part.where("p_size = 7").select(*rules("exact", F.col("p_name"), "part:", F.col("p_name"))))
    return jb.route_texts(part.select("p_partkey", "p_name"), made.distinct(), "p_name")


# --- sets ---------------------------------------------------------------------------
@register(
    "distinct_records",
    """WITH b AS (SELECT year(o_orderdate)::INTEGER AS year, o_custkey FROM orders),
f AS (SELECT o_custkey, min(year) AS first FROM b GROUP BY 1)
SELECT year, count(DISTINCT o_custkey) AS record_count, (SELECT count(*) FROM f WHERE first = b.year) AS new_records,
  (SELECT count(*) FROM f) AS all_records FROM b GROUP BY year""",
)
def distinct_records(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of each year's bundle, new ones and all, from bitmaps that are made once for each month."""
    orders = table(spark, folder, "orders")
    month = F.trunc("o_orderdate", "month").alias("month")
    bitmaps = settle(sets.record_bitmaps(orders.select(month, "o_custkey"), ["month"], "o_custkey"))
    yearly = bitmaps.withColumn("year", F.year("month"))
    everything = sets.merged_counts(bitmaps, count="all_records")
    found = sets.merged_counts(yearly, ["year"]).join(sets.new_records(yearly, "year"), "year")
    return found.crossJoin(everything)  # one row


SET_SOURCES = {"buyers": ("orders", "o_custkey"), "users": ("events", "user_id"), "makers": ("supplier", "s_suppkey"), "customers": ("customer", "c_custkey")}


@register(
    "code_set_algebra",
    """WITH s AS (SELECT DISTINCT 'buyers' AS n, o_custkey AS k FROM orders UNION SELECT 'users', user_id FROM events
  UNION SELECT 'makers', s_suppkey FROM supplier UNION SELECT 'customers', c_custkey FROM customer),
p AS (SELECT DISTINCT a.n AS left_source, b.n AS right_source FROM s a, (SELECT DISTINCT n FROM s) b WHERE a.n <> b.n),
c AS (SELECT left_source, right_source, (SELECT count(*) FROM s a SEMI JOIN (SELECT k FROM s WHERE n = right_source) b USING (k) WHERE a.n = left_source) AS common,
  (SELECT count(*) FROM s WHERE n = left_source) AS l, (SELECT count(*) FROM s WHERE n = right_source) AS r FROM p)
SELECT left_source, right_source, common, l - common AS left_only, r - common AS right_only,
  CASE WHEN l = common AND r = common THEN 'equal' WHEN l = common THEN 'subset' WHEN r = common THEN 'superset' WHEN common = 0 THEN 'disjoint' ELSE 'overlap' END AS relation FROM c""",
)
def code_set_algebra(spark: SparkSession, folder: str) -> DataFrame:
    frames = {n: table(spark, folder, t).select(F.col(c).alias("code")) for n, (t, c) in SET_SOURCES.items()}
    return sets.set_relations(sets.memberships(frames, "code"), list(SET_SOURCES))


# --- fields and responses -----------------------------------------------------------
@register(
    "json_field_audit",
    """WITH d AS (SELECT event_type, event_id % 3 = 0 AS extra FROM events)
SELECT event_type, count(*) AS documents, CASE WHEN bool_or(extra) THEN 'OBJECT<fetched: STRING, k: BIGINT>' ELSE 'OBJECT<k: BIGINT>' END AS merged_schema
FROM d GROUP BY 1""",
)
def json_field_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The merged shape of the properties of each kind of event, of which a third have one more member."""
    more = F.concat(F.lit('{"fetched": "now", '), F.substring_index("props", "{", -1))
    text = F.when(F.col("event_id") % 3 == 0, more).otherwise(F.col("props"))
    docs = table(spark, folder, "events").select("event_type", F.parse_json(text).alias("v"))
    return qa.field_audit(docs, ["event_type"], "v")


@register(
    "repeated_responses",
    """SELECT user_id, event_type, sha256('{"event":"' || event_type || '","k":' || json_extract(props, '$.k') || '}') AS digest, count(*) AS copies
FROM events GROUP BY 1, 2, 3 HAVING count(*) > 1""",
)
def repeated_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Equal answers to one user, whatever the order of the members in their text."""
    k = F.get_json_object("props", "$.k")
    one = F.concat(F.lit('{"k": '), k, F.lit(', "event": "'), F.col("event_type"), F.lit('"}'))
    other = F.concat(F.lit('{"event" :"'), F.col("event_type"), F.lit('","k":'), k, F.lit("}"))
    text = F.when(F.col("event_id") % 2 == 0, one).otherwise(other)
    docs = table(spark, folder, "events").select("user_id", "event_type", F.parse_json(text).alias("v"))
    return qa.repeated_responses(docs, ["user_id", "event_type"], "v")
