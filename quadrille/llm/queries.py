"""The operators of this subpackage over the given tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bag_search,
    bpe,
    chosen_path,
    cover_codes,
    lattice,
    packing,
    pages,
    pii,
    quality,
    resampling,
    secret_scan,
    shards,
    substrings,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


#: Words of every document, as SQL.
_WORDS = r"""
words AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents)"""

#: Components of ``links(a, b)`` over ``nodes(id)``, as SQL.
_REACHED = """
reached AS (
  SELECT id, id AS r FROM nodes
  UNION SELECT reached.id, links.b FROM reached JOIN links ON links.a = reached.r)"""

_LINKED = """
SELECT id AS {id}, (SELECT count(*) FROM links WHERE a = id) AS n_links,
       min(r) AS component_id, id = min(r) AS kept
FROM reached GROUP BY id
"""

ORACLES["op5_jaccard"] = f"""
WITH RECURSIVE {_WORDS},
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p+1:p+5], ' ') AS s
  FROM (SELECT *, unnest(range(0, greatest(len(ws)-4, 1))) AS p FROM words WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE c.n / (x.n + y.n - c.n) >= cast(0.8 AS double)),
nodes AS (SELECT doc_id AS id FROM documents),
{_REACHED}
{_LINKED.format(id="doc_id")}"""

ORACLES["op7_substrings"] = f"""
WITH {_WORDS},
windows AS (
  SELECT doc_id, p, array_to_string(ws[p+1:p+20], ' ') AS s
  FROM (SELECT *, unnest(range(0, len(ws)-19)) AS p FROM words WHERE len(ws) >= 20)),
later AS (
  SELECT doc_id, p FROM windows
  QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(p, p+20)) AS i FROM later),
single AS (SELECT doc_id, unnest(range(0, len(ws))) AS i, unnest(ws) AS word FROM words),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM single ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, cast(len(ws) AS bigint) AS n_words,
       cast(len(ws) - coalesce(n, 0) AS bigint) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

ORACLES["op10_lattice"] = f"""
WITH RECURSIVE nodes AS (
  SELECT vec_id AS id, label, cast(embedding AS double[]) AS e FROM embeddings),
links AS (
  SELECT a.id AS a, b.id AS b FROM nodes a JOIN nodes b ON a.label = b.label AND a.id <> b.id
  WHERE list_cosine_similarity(a.e, b.e) >= cast(0.98 AS double)),
{_REACHED}
{_LINKED.format(id="vec_id")}"""


def _matches(number: int, rule: secret_scan.Rule) -> str:
    """Spans of a rule as SQL: a match starts after the gaps and matches before it."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {number} AS number, '{rule.kind}' AS kind, a, a + length(m) AS b
  FROM (SELECT doc_id, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda i:
          list_sum(list_transform(gaps[1:i], lambda g: length(g)))
          + coalesce(list_sum(list_transform(ms[1:i-1], lambda g: length(g))), 0))) AS a
        FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms,
                     regexp_split_to_array(text, '{pattern}') AS gaps
              FROM documents WHERE regexp_matches(text, '{pattern}')))
  WHERE length(regexp_extract(m, '{pattern}', {rule.group})) >= {rule.least}"""


ORACLES["op13_secrets"] = f"""
WITH found AS ({" UNION ALL ".join(_matches(*r) for r in enumerate(secret_scan.RULES))}),
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
         count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(concat_ws(':', kind, a, b), ',' ORDER BY a, number)
           FILTER (number < {len(secret_scan.BASE_RULES)}) AS base,
         string_agg(concat_ws(':', kind, a, b), ',' ORDER BY a, number) AS spans, count(*) AS n
  FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n, 0) AS n_spans
FROM documents LEFT JOIN listed USING (doc_id)
"""

_TERMS = f"""regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{bag_search.TERM}')"""

ORACLES["op12_search"] = f"""
WITH terms AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
total AS (SELECT count(*) AS docs, cast(sum(n) AS bigint) AS terms FROM lengths),
weights AS (
  SELECT term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS bigint) AS w
  FROM tf, total GROUP BY term, docs),
asked AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark),
scores AS (
  SELECT item_id, doc_id, cast(sum(
    w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS bigint) AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), total
  GROUP BY ALL)
SELECT item_id, doc_id, score,
       cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS int) AS rank
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""


def _assigned(books: str) -> str:
    """Nearest entry of every part, as SQL."""
    return f"""
  SELECT vec_id, part, x, entry, d FROM (
    SELECT vec_id, part, p.x, entry, list_sum(list_transform(list_zip(p.x, b.x),
      lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM parts p JOIN {books} b USING (part))
  QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1"""


def _moved(books: str, assigned: str) -> str:
    """Codebooks after a round, as SQL."""
    return f"""
  SELECT part, entry, coalesce(m.x, b.x) AS x FROM {books} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY place) AS x FROM (
      SELECT part, entry, place, cast(floor(sum(x[place]) / count(*)) AS bigint) AS mean
      FROM (SELECT *, unnest(range(1, len(x) + 1)) AS place FROM {assigned}) GROUP BY ALL)
    GROUP BY part, entry) m USING (part, entry)"""


ORACLES["op11_codes"] = f"""
WITH vectors AS MATERIALIZED (
  SELECT vec_id, label,
         list_transform(embedding, lambda x: cast(floor(256 * x) AS bigint)) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding,
    lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS x
  FROM vectors, (SELECT unnest(range(16)) AS part)),
books0 AS MATERIALIZED (
  SELECT part, entry, x FROM parts JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM vectors
    QUALIFY entry < 64) USING (vec_id)),
codes0 AS MATERIALIZED ({_assigned("books0")}),
books1 AS MATERIALIZED ({_moved("books0", "codes0")}),
codes1 AS MATERIALIZED ({_assigned("books1")}),
books2 AS MATERIALIZED ({_moved("books1", "codes1")}),
codes2 AS MATERIALIZED ({_assigned("books2")}),
coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
         cast(sum(d) AS bigint) AS error
  FROM codes2 GROUP BY vec_id)
SELECT vec_id, code, error,
       cast(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry))
        FROM books2) AS codebooks_sha256
FROM coded JOIN vectors USING (vec_id)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return bpe.encode_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        keep_ids=False,
    )


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, posterior and verdict of every document."""
    return quality.judge_quality(table(spark, sf_dir, "documents")).drop("row")


#: Shards of the registered query.
SHARDS = tuple(f"shard-{i:03}" for i in range(256))


@query
def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    docs = table(spark, sf_dir, "documents")
    placed = shards.place_on_shards(docs, SHARDS)
    return placed.select("doc_id", "slot", "shard", "n_chars")


@query
def op10_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector."""
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document and their places in sequences."""
    return packing.pack_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
    )


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


@query
def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that windows of 20 words leave."""
    return substrings.drop_repeated_passages(table(spark, sf_dir, "documents"))


@query
def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    return chosen_path.near_documents(docs).drop("row_id", "row_mark", "row_group")


@query
def op4_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pages.extract_main_text(table(spark, sf_dir, "pages"))


@query
def op3_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and verdict of every document.

    The target texts are of good quality and not toxic; the share that is kept is that
    of good quality.
    """
    labels = table(spark, sf_dir, "labels")
    good = F.col("quality") == 1
    return resampling.resample(
        table(spark, sf_dir, "documents"),
        labels,
        good & (F.col("toxic") == 0),
        share=resampling.share_of(labels, good, None),
    )


@query
def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


@query
def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every item."""
    return bag_search.rank_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and errors of every vector."""
    return cover_codes.compress(table(spark, sf_dir, "embeddings"))
