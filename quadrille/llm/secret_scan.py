"""Secrets in texts, found by regular expressions behind a trigram index.

Each expression is turned into a Boolean query of trigrams that its matches must hold
(``trigrams``).  Texts are indexed in segments of a few megabytes; the postings of a
segment are intersected and united as the query says, and the expression runs over the
candidates only.  An expression that implies no trigram scans all texts.

``find_secrets`` builds a segment and searches it in the same task, so texts do not move.
``index_documents`` gives the postings of all trigrams as a table to be kept; with
``candidate_documents`` rules that come later read the postings of their trigrams alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, named, slices, text_id
from .trigrams import ALL, Segment, evaluate, mentioned, query_of

#: Bytes of text in a segment of the index.
SEGMENT_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose group ``group`` has at least ``least`` characters.

    Matches are leftmost and do not overlap; classes and case are those of ASCII.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


#: Rules that always hold.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 6, 2),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]{24,}", 24),
)

#: Public formats of keys, which no other text is likely to have.
RULES = (
    *BASE_RULES,
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY( BLOCK)?-----"),
    Rule("session_key", "ASIA[A-Z0-9]+", 20),
    Rule("github", "(gh[pousr]_[A-Za-z0-9]+|github_pat_[A-Za-z0-9_]+)", 36),
    Rule("gitlab", "glpat-[A-Za-z0-9_-]+", 26),
    Rule("slack", "xox[abeoprs]-[A-Za-z0-9-]+", 24),
    Rule("slack_hook", r"hooks\.slack\.com/services/[A-Za-z0-9+/]+", 40),
    Rule("google", "AIza[A-Za-z0-9_-]+", 39),
    Rule("stripe", "[rs]k_(live|test)_[A-Za-z0-9]+", 24),
    Rule("npm", "npm_[A-Za-z0-9]+", 40),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("bearer", r"(?i:bearer\x20+([A-Za-z0-9+/_.=-]+))", 16, 1),
    Rule("url", r"""(https?|ftp|ssh|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\x00-\x20/:@"'<>]+:[^\x00-\x20/@"'<>]+@[A-Za-z0-9.-]+"""),
)


class Scanner:
    """The rules with their queries, in a worker."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = [(r, re.compile(r.pattern, re.ASCII), query_of(r.pattern)) for r in rules]
        self.wanted = np.zeros(1 << 24, bool)
        for *_, query in self.rules:
            self.wanted[list(mentioned(query))] = True

    def spans(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """Spans ``(start, number of the rule, end)`` of each text, in order."""
        segment = Segment(texts, self.wanted)
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        decoded: dict[int, str] = {}
        for number, (rule, pattern, query) in enumerate(self.rules):
            for place in segment.candidates(query).tolist():
                if place not in decoded:
                    decoded[place] = texts[place].as_py()
                for m in pattern.finditer(decoded[place]):
                    a, b = m.span(rule.group)
                    if b - a >= rule.least:
                        found[place].append((m.start(), number, m.end()))
        for spans in found:
            spans.sort()
        return found


def find_secrets(
    documents: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Spans of secrets in each text, in code points.

    One row per input row: the id, ``n_assign``, ``n_access`` and ``n_hex`` (spans of the
    base rules), ``base_sha256`` (of their spans as ``kind:start:end``, by start, then in
    the order of the rules), ``spans`` (those of all rules, likewise) and ``n_spans``.
    Base rules come first whether ``rules`` names them or not.  A null text counts as
    empty and has no spans; ids that are no numbers become null; null ids and repeated
    rows stay as they are; other columns are not read, so their names cannot clash; an
    empty table gives no rows.  Rows are independent of each other, and texts of any
    length are searched whole.
    """
    rules = (*BASE_RULES, *[r for r in rules if r not in BASE_RULES])
    base = len(BASE_RULES)
    counts = [f"n_{r.kind}" for r in BASE_RULES]

    def listed(spans) -> str:
        return ",".join(f"{rules[n].kind}:{a}:{b}" for a, n, b in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for whole in batches:
            for batch in slices(whole, 1, SEGMENT_BYTES):
                spans = scanner.spans(batch.column(1))
                certain = [[s for s in row if s[1] < base] for row in spans]
                numbers = [
                    pa.array([sum(s[1] == n for s in row) for row in certain], pa.int64())
                    for n in range(base)
                ]
                digests = [hashlib.sha256(listed(row).encode()).hexdigest() for row in certain]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        *numbers,
                        pa.array(digests, pa.string()),
                        pa.array(map(listed, spans), pa.string()),
                        pa.array(map(len, spans), pa.int64()),
                    ],
                    ["id", *counts, "base_sha256", "spans", "n_spans"],
                )

    rows = documents.select(
        F.col(id_column).try_cast("bigint").alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    fields = ", ".join(f"{c} bigint" for c in counts)
    schema = f"id bigint, {fields}, base_sha256 string, spans string, n_spans bigint"
    return map_arrow(rows, run, schema).withColumnRenamed("id", id_column)


# --- an index to be kept ----------------------------------------------------------

#: Stands for a posting that lists all texts of a segment.
EVERY = -1


def index_documents(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Postings ``segment, trigram, ids`` of all trigrams; write it sorted by trigram.

    A segment holds a few megabytes of text of one task, so every row has a bound.  The
    posting of ``EVERY`` lists all texts of its segment.  Null texts count as empty; a
    row without an id gets one from its text, which ``candidate_documents`` shows as null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in slices(whole, 1, SEGMENT_BYTES):
                segment = Segment(batch.column(1))
                ids = batch.column(0).to_numpy()
                bounds = np.concatenate([[0], segment.end, [len(segment.text) + len(ids)]])
                members = np.concatenate([ids[segment.text], ids])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(bounds) - 1, number)),
                        pa.array(np.append(segment.trigrams, EVERY).astype(np.int32)),
                        pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(members)),
                    ],
                    ["segment", "trigram", "ids"],
                )
                number += 1

    rows = documents.select(
        text_id(id_column, text_column).alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    return map_arrow(rows, run, "segment bigint, trigram int, ids array<bigint>")


def candidate_documents(
    index: DataFrame, rules: Sequence[Rule], id_column: str = "doc_id"
) -> DataFrame:
    """``kind`` and the id of the texts whose trigrams satisfy the query of a rule.

    Only the postings that the rules mention are read; those of a segment are brought
    together, and the query becomes an expression over them.  Every match of a rule is in
    a candidate of its kind.
    """
    queries = {r.kind: query_of(r.pattern) for r in rules}
    wanted = sorted({EVERY}.union(*map(mentioned, queries.values())))
    postings = (
        index.where(F.col("trigram").isin(wanted))
        .groupBy("segment")
        .agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("of"))
    )

    def posting(trigram: int) -> Column:
        none = F.array().cast("array<bigint>")
        return F.coalesce(F.try_element_at("of", F.lit(trigram)), none)

    def members(query) -> Column:
        if query == ALL:
            return posting(EVERY)
        return evaluate(query, posting, F.array_intersect, F.array_union)

    kinds = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), members(query).alias("ids"))
            for kind, query in queries.items()
        ]
    )
    found = postings.select(F.inline(kinds)).select("kind", F.explode("ids").alias("id"))
    return found.select("kind", named("id").alias(id_column))
