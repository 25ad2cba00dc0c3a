"""The registered query of every operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.decontamination import find_passages
from tidemark.llm.exact_search import top_products
from tidemark.llm.language_id import identify
from tidemark.llm.lexical_search import ranked_search
from tidemark.llm.license_scan import find_licenses
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.merkle import fold, leaf_digest, merkle_manifest, proof_digest
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.neighbours import nearest
from tidemark.llm.packing import pack
from tidemark.llm.quality import score_quality
from tidemark.llm.token_counts import token_counts
from tidemark.llm.url_filter import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(builder):
        QUERIES[name] = builder
        if sql is not None:
            ORACLES[name] = sql
        return builder

    return add


@query("op1_packing")
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"))


#: Words of a text as the contract has them, in DuckDB.
_SQL_WORDS = r"regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op2_decontamination",
    f"""WITH d AS (SELECT doc_id, {_SQL_WORDS.format(t="coalesce(text, '')")} AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS.format(t="coalesce(text, '')")} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
m AS (SELECT doc_id, item_id, i, dw.k FROM dw JOIN bw ON dw.win = bw.win AND dw.k = bw.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM m) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""",
)
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query(
    "op5_line_dedup",
    r"""WITH l AS (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
k AS (SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
hot AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE hot.key IS NOT NULL)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE hot.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN hot ON k.key = hot.key GROUP BY doc_id""",
)
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


#: The rules of the query.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query("op3_url_filter")
def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), URL_RULES, steps=None)


@query(
    "op8_near_dedup",
    r"""WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(3, len(w)) - 1), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY 1)
SELECT t.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, t.doc_id = component_id AS kept
FROM t LEFT JOIN n USING (doc_id) JOIN c ON c.node = t.doc_id""",
)
def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), width=3, similarity=(85, 100))


@query("op10_language_id")
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    found = identify(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query("op7_neighbours")
def op7_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


#: Licence notices.
LICENSE_NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]

_GPL = "under the terms of the GNU {}General Public License as published by the Free Software Foundation"
_CC = "This work is licensed under a Creative Commons Attribution-{} 4.0 International License"
_GNU = "This work is licensed under the GNU {}General Public License, version {}"
#: Notices that hold most of a notice above and name another licence, or another version of it. A header
#: without a version counts as the version it has here; the GPL's counts as GPL-3.0, as above.
SIBLING_NOTICES = [
    ("AGPL-3.0", _GPL.format("Affero ")),
    ("AGPL-3.0", _GPL.format("Affero ") + ", either version 3 of the License"),
    ("AGPL-3.0", _GNU.format("Affero ", "3")),
    ("CC-BY-NC-4.0", _CC.format("NonCommercial")),
    ("CC-BY-NC-ND-4.0", _CC.format("NonCommercial-NoDerivatives")),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0"),
    ("CC-BY-NC-SA-4.0", _CC.format("NonCommercial-ShareAlike")),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-ND-4.0", _CC.format("NoDerivatives")),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-SA-4.0", _CC.format("ShareAlike")),
    ("GPL-2.0", _GPL.format("") + "; either version 2 of the License"),
    ("GPL-2.0", _GPL.format("") + "; version 2 of the License"),
    ("GPL-2.0", _GNU.format("", "2")),
    ("GPL-3.0", _GPL.format("") + ", either version 3 of the License"),
    ("GPL-3.0", _GPL.format("") + ", version 3 of the License"),
    ("LGPL-2.0", _GPL.format("Library ")),
    ("LGPL-2.0", _GPL.format("Library ") + "; either version 2 of the License"),
    ("LGPL-2.1", _GPL.format("Lesser ") + "; either version 2.1 of the License"),
    ("LGPL-2.1", _GPL.format("Lesser ") + "; version 2.1 of the License"),
    ("LGPL-2.1", _GNU.format("Lesser ", "2.1")),
    ("LGPL-3.0", _GPL.format("Lesser ")),
    ("LGPL-3.0", _GPL.format("Lesser ") + ", either version 3 of the License"),
    ("LGPL-3.0", _GNU.format("Lesser ", "3")),
]


def _sql_licenses(documents: str = "documents") -> str:
    """By brute force: every notice in every window of its scale, where its match lies, and what no sibling beats there."""
    notices = LICENSE_NOTICES + SIBLING_NOTICES
    names = ", ".join("({}, '{}', '{}')".format(i, a, b.replace("'", "''")) for i, (a, b) in enumerate(notices))
    words = "list_filter(regexp_split_to_array(lower(coalesce({t}, '')), '[^a-z0-9]+'), lambda x: x <> '')"
    return f"""WITH t AS (SELECT t, license, {words.format(t="text")} AS w FROM (VALUES {names}) v(t, license, text)),
ti AS (SELECT t, license, CASE WHEN len(w) <= 6 THEN 6 WHEN len(w) <= 12 THEN 12 WHEN len(w) <= 24 THEN 24 ELSE 48 END AS s,
  i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT t, license, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
tf AS (SELECT t, license, s, g, min(i) AS i FROM ti GROUP BY t, license, s, g),
ts AS (SELECT t, license, s, g, row_number() OVER (PARTITION BY t ORDER BY i) AS idx, count(*) OVER (PARTITION BY t) AS whole FROM tf),
d AS (SELECT doc_id, {words.format(t="text")} AS w FROM {documents}),
ds AS (SELECT doc_id, i - 1 AS p, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
h AS (SELECT doc_id, t, license, whole, p, ds.g, p - idx AS shift, unnest(range(greatest(0, CAST(ceil((p - (s + s // 2 - 3) + 1) / (s // 2)) AS BIGINT)), p // (s // 2) + 1)) AS k
  FROM ds JOIN ts ON ds.g = ts.g),
c AS (SELECT doc_id, t, license, whole, k, count(DISTINCT g) / whole AS containment FROM h GROUP BY doc_id, t, license, whole, k HAVING count(DISTINCT g) / whole >= 0.8),
r AS (SELECT doc_id, t, k, shift, whole, count(DISTINCT g) AS found, list(p ORDER BY p) AS places FROM (
  SELECT DISTINCT x.doc_id, x.t, x.k, x.shift, y.whole, y.g, y.p FROM c JOIN h x USING (doc_id, t, k) JOIN h y ON x.doc_id = y.doc_id AND x.t = y.t AND x.k = y.k
  AND y.shift BETWEEN x.shift AND x.shift + x.whole // 4) GROUP BY doc_id, t, k, shift, whole),
l AS (SELECT doc_id, t, k, 2 * found - whole AS lead, places FROM r QUALIFY row_number() OVER (PARTITION BY doc_id, t, k ORDER BY found DESC, shift) = 1),
m AS (SELECT DISTINCT doc_id, license, k, t, containment, lead, places FROM c JOIN l USING (doc_id, t, k)),
f AS (SELECT doc_id, license, max(containment) AS best FROM m x WHERE NOT EXISTS (SELECT 1 FROM m y WHERE y.doc_id = x.doc_id AND y.license <> x.license
  AND (y.lead > x.lead OR (y.lead = x.lead AND y.containment > x.containment)) AND 2 * len(list_intersect(x.places, y.places)) >= least(len(x.places), len(y.places))) GROUP BY 1, 2)
SELECT d.doc_id, coalesce(string_agg(license, ',' ORDER BY license), '') AS licenses, count(license)::BIGINT AS n_licenses,
  coalesce(max(best), 0)::DOUBLE AS containment FROM d LEFT JOIN f USING (doc_id) GROUP BY 1"""


@query("op9_license_scan", _sql_licenses())
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = (
        find_licenses(docs, LICENSE_NOTICES + SIBLING_NOTICES)
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_set("license")).alias("names"), F.max("containment").alias("containment"))
    )
    return docs.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id",
        F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"),
        F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("n_licenses"),
        F.coalesce("containment", F.lit(0.0)).alias("containment"),
    )


@query("op6_quality")
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(table(spark, folder, "documents"))


@query(
    "op11_exact_topk",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (SELECT a.vec_id AS query_id, b.vec_id, max(list_inner_product(a.v, b.v))::BIGINT AS score
  FROM v a JOIN v b ON len(a.v) = len(b.v) AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5""",
)
def op11_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_products(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


#: Terms of a text as the contract of the search has them, in DuckDB.
_SQL_TERMS = _SQL_WORDS.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")


@query(
    "op12_lexical_search",
    f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_TERMS.format(t="coalesce(text, '')")} AS w FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS n, coalesce(sum(len(w)), 0)::BIGINT AS l FROM d),
f AS (SELECT r, doc_id, t, count(*) AS tf, len AS n FROM (SELECT r, doc_id, len(w) AS len, unnest(w) AS t FROM d) GROUP BY ALL),
v AS (SELECT t, floor(1000 * ln((2 * s.n + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM f GROUP BY 1), s),
q AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest({_SQL_TERMS.format(t="text")}) AS t
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)) GROUP BY 1, 2),
p AS (SELECT item_id, r, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * f.n * s.n) // s.l))))::BIGINT AS score
  FROM q JOIN v USING (t) JOIN f USING (t), s GROUP BY 1, 2, 3),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM p WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 10""",
)
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The columns of a leaf, in their order.
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def _sql_leaf(text: str) -> str:
    values = ["doc_id::VARCHAR", "source::VARCHAR", "lang::VARCHAR", "n_chars::VARCHAR", text]
    return "sha256(concat(" + ", ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + "))"


@query(
    "op13_merkle_manifest",
    f"""WITH RECURSIVE
crc AS (SELECT doc_id AS id, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
d AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {_sql_leaf("text")} AS leaf,
  CASE WHEN crc % 3 = 0 THEN {_sql_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS tampered
  FROM documents LEFT JOIN crc ON id = doc_id),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
t AS (SELECT g, 0 AS lvl, pos, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM p
  UNION ALL SELECT g, lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM t WHERE n > 1 GROUP BY g, lvl, n, pos // 8),
s AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS place FROM t WHERE n = 1),
u AS (SELECT 1000 AS lvl, place AS pos, subroot AS h, count(*) OVER () AS n FROM s
  UNION ALL SELECT lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM u WHERE n > 1 GROUP BY lvl, n, pos // 8),
sib AS (SELECT x.g, x.lvl, x.pos, coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (WHERE y.pos < x.pos), '') AS b,
    coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (WHERE y.pos > x.pos), '') AS a
  FROM t x JOIN t y ON x.g = y.g AND x.lvl = y.lvl AND x.pos // 8 = y.pos // 8 WHERE x.n > 1 GROUP BY ALL),
usib AS (SELECT x.lvl, x.pos, coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (WHERE y.pos < x.pos), '') AS b,
    coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (WHERE y.pos > x.pos), '') AS a
  FROM u x JOIN u y ON x.lvl = y.lvl AND x.pos // 8 = y.pos // 8 WHERE x.n > 1 GROUP BY ALL),
way AS (SELECT p.g, p.pos, lvl, b, a FROM p JOIN sib ON p.g = sib.g AND sib.pos = p.pos // (8 ** lvl)::BIGINT
  UNION ALL SELECT p.g, p.pos, lvl, b, a FROM p JOIN s USING (g) JOIN usib ON usib.pos = s.place // (8 ** (lvl - 1000))::BIGINT),
path AS (SELECT g, pos, list({{'b': b, 'a': a}} ORDER BY lvl) AS path, sha256(string_agg(b || a, '' ORDER BY lvl)) AS proof FROM way GROUP BY ALL),
f AS (SELECT p.doc_id, p.leaf, subroot, (SELECT h FROM u WHERE n = 1) AS root, coalesce(proof, sha256('')) AS proof_sha256,
    list_reduce(list_prepend({{'b': coalesce(tampered, leaf), 'a': ''}}, coalesce(path, [])),
      lambda x, y: {{'b': sha256(y.b || x.b || y.a), 'a': ''}}).b AS folded_root
  FROM p JOIN s USING (g) LEFT JOIN path ON path.g = p.g AND path.pos = p.pos)
SELECT *, folded_root = root AS verified FROM f""",
)
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    lowered = [F.col(c) for c in LEAF[:-1]] + [F.translate("text", _UPPER, _LOWER)]
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = merkle_manifest(docs, LEAF, carried={"tampered": F.when(picked, leaf_digest(*lowered))})
    hexed = lambda c: F.lower(F.hex(c))
    found = rows.select(
        "doc_id",
        hexed("digest").alias("leaf"),
        hexed("subroot").alias("subroot"),
        hexed("root").alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("tampered", "digest"), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
