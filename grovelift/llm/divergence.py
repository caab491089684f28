"""An audit of how far sources of one language differ, by a frequent-pattern tree of term rows.

Every kept term of a language has a smoothed share p in each of its sources; two
sources differ by the sum of |p - q| over all kept terms. Most counts are zero,
and a source has the same share z for all terms that it lacks, so

    sum |p - q|  =  V |z - z'|                            every term, as if both lacked it
                  + sum (|p - z'| - |z - z'|)             terms that one of the two has
                  + sum (|p - q| - |p - z'| - |z - q| + |z - z'|)  terms that both have.

The first two parts follow from the shares of one source at a time. For the
third, a term is a row of its nonzero shares in the order of sources, and rows
are inserted into a prefix tree with their multiplicities. Each node then adds
its correction with each of its ancestors once, for all rows that share the
path. Trees hold a bounded number of nodes; what they give is added up.

Counts are taken over whole texts and all documents, first within tasks, then
by grouped sums. All arithmetic is on integers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grovelift.llm.common import checkpointed
from grovelift.operators.sizing import broadcast_if_small, measured

LEAST_DOCUMENTS = 30
TOP_TERMS = 50
SMOOTHING = 5
SCALE = 1_000_000_000
# Distinct (group, term) pairs that a task holds before it passes counts on.
_HELD_COUNTS = 400_000
# Node-ancestor pairs after which a task passes its corrections on.
_HELD_PAIRS = 1_000_000
# Rows of one language are dealt out over so many parts where all meet all.
_PARTS = 16
# A-Z in lower case, all else that is ASCII a separator; other bytes belong to letters.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_TERM_BYTES).split()


def _counted(counts: dict, documents: dict) -> pa.RecordBatch:
    langs, sources, terms, n, docs = [], [], [], [], []
    for (lang, source), held in counts.items():
        langs += [lang] * len(held)
        sources += [source] * len(held)
        terms += held.keys()
        n += held.values()
        docs += map(documents[lang, source].__getitem__, held)
    columns = [
        pa.array(langs, pa.string()),
        pa.array(sources, pa.string()),
        pa.array(terms, pa.binary()).cast(pa.string()),
        pa.array(n, pa.int64()),
        pa.array(docs, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences, and documents that hold the term, per (lang, source, term) of a task."""
    counts: dict[tuple, Counter] = defaultdict(Counter)
    documents: dict[tuple, Counter] = defaultdict(Counter)
    held = 0
    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        texts = batch.column("text").cast(pa.binary())
        for lang, source, text in zip(langs, sources, texts, strict=True):
            found = terms_of(text.as_py())
            own = counts[lang, source]
            held -= len(own)
            own.update(found)
            held += len(own)
            documents[lang, source].update(set(found))
            if held > _HELD_COUNTS:
                yield _counted(counts, documents)
                counts.clear(), documents.clear()
                held = 0
    yield _counted(counts, documents)


class PatternTree:
    """Rows of (source, p, z) in source order, merged where they begin alike.

    `walk` adds up, per pair of sources that a row has both of, the corrections
    of all rows inserted.
    """

    def __init__(self):
        self.places: dict[tuple, int] = {}
        self.sources: dict[str, int] = {}
        # Of each node its parent, depth, source, p, z and number of rows; node 0 is the root.
        self.nodes: list[list[int]] = [[0, 0, 0, 0, 0, 0]]
        self.pairs = 0

    def insert(self, path: list[tuple], times: int) -> None:
        node = 0
        for depth, (source, p, z) in enumerate(path, 1):
            number = self.sources.setdefault(source, len(self.sources))
            below = self.places.setdefault((node, number, p), len(self.nodes))
            if below == len(self.nodes):
                self.nodes.append([node, depth, number, p, z, 0])
                self.pairs += depth - 1
            self.nodes[below][-1] += times
            node = below

    def walk(self) -> dict[tuple[str, str], int]:
        """Correction per (earlier source, later source); each node meets each ancestor once.

        All nodes of one depth climb to their ancestors together.
        """
        parent, depth, source, p, z, rows = np.array(self.nodes, np.int64).T
        sums: dict[int, int] = defaultdict(int)
        for level in range(2, int(depth.max()) + 1):
            own = np.flatnonzero(depth == level)
            up = own
            for _ in range(level - 1):
                up = parent[up]
                added = np.abs(p[up] - p[own]) - np.abs(p[up] - z[own]) - np.abs(z[up] - p[own])
                added = (added + np.abs(z[up] - z[own])) * rows[own]
                codes, which = np.unique(source[up] * len(self.sources) + source[own], return_inverse=True)
                values = np.zeros(len(codes), np.int64)
                np.add.at(values, which, added)
                for code, value in zip(codes.tolist(), values.tolist(), strict=True):
                    sums[code] += value
        names = list(self.sources)
        return {
            (names[code // len(names)], names[code % len(names)]): value
            for code, value in sums.items()
        }


def _corrections(lang: str, tree: PatternTree) -> pa.RecordBatch:
    sums = {pair: value for pair, value in tree.walk().items() if value}
    first, second = zip(*sums, strict=True) if sums else ((), ())
    columns = [
        pa.array([lang] * len(sums), pa.string()),
        pa.array(first, pa.string()),
        pa.array(second, pa.string()),
        pa.array(list(sums.values()), pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "source", "item", "value"])


def _grow_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections of the rows of a task: a tree per language, passed on when it is large."""
    trees: dict[str, PatternTree] = defaultdict(PatternTree)
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("lang", "path", "times"))
        for lang, path, times in zip(*columns, strict=True):
            tree = trees[lang]
            tree.insert([(x["source"], x["p"], x["z"]) for x in path], times)
            if tree.pairs > _HELD_PAIRS:
                yield _corrections(lang, trees.pop(lang))
    for lang, tree in trees.items():
        yield _corrections(lang, tree)


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 5) / (total + 5 * kept)), exact; null if there is no kept term."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + SMOOTHING).cast("decimal(20,0)")
    below = total + SMOOTHING * kept
    return F.when(below > 0, F.call_function("div", above, below.cast("decimal(20,0)")) + 1)


def _distance(x: str | Column, y: str | Column) -> Column:
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    return F.abs(x - y)


def term_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term."""
    rows = documents.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    )
    schema = "lang string, source string, term string, n long, docs long"
    counted = rows.mapInArrow(_count_terms, schema)
    return counted.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def _term_rows(counts: DataFrame, least: int) -> DataFrame:
    """(lang, term, total, found): kept terms with their counts per source, in source order.

    A row has one entry per source of the language at most; the result has a
    row per pair of sources, so their number is bounded by what is asked for.
    """
    found = F.sort_array(F.collect_list(F.struct("source", "n"))).alias("found")
    rows = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), found
    )
    return rows.where(F.col("docs") >= least).drop("docs")


def source_divergence(
    documents: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS
) -> DataFrame:
    """lang, source, part, item, value and rank: how a source differs, and by what.

    Part `pair` has, for each other source of the language as item, the summed
    difference of the shares of all kept terms. Part `term` has the `top` terms
    whose share is furthest above that in the whole language, among terms that
    the source has. Ranks count from 1, by value descending, then item.

    A term is kept if `least` documents of the language hold it. Null text, lang
    and source count as empty ones, which are values like others. Groups without
    terms, and languages without kept terms (all values 0), are there too.
    Repeated rows count as often as they occur, very long texts whole; other
    columns are ignored. Without documents there are no rows.
    """
    groups = documents.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    ).distinct()
    rows = checkpointed(_term_rows(term_counts(documents), least))
    # Total and number of kept terms per language, and total per group.
    langs = rows.groupBy("lang").agg(F.sum("total").alias("all_n"), F.count(F.lit(1)).alias("kept"))
    held = rows.select("lang", "term", "total", F.explode("found").alias("at"))
    held = held.select("lang", "term", "total", "at.source", "at.n")
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("own_n"))
    groups = (
        groups.join(langs, "lang", "left")
        .join(sums, ["lang", "source"], "left")
        .na.fill(0, ["all_n", "kept", "own_n"])
        .withColumn("z", F.coalesce(share(F.lit(0), F.col("own_n"), F.col("kept")), F.lit(0)))
    )
    groups = checkpointed(groups)

    # A row per group, broadcast if that is little; a hot source is not shuffled then.
    stated = broadcast_if_small(groups, measured(groups, F.concat("lang", "source")))
    shares = held.join(stated, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        share(F.col("n"), F.col("own_n"), F.col("kept")).alias("p"),
        share(F.col("total"), F.col("all_n"), F.col("kept")).alias("q"),
        "z",
    )
    shares = checkpointed(shares)
    order = [F.desc("value"), F.col("item")]
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))

    def ranked(part: str, values: DataFrame) -> DataFrame:
        return values.withColumn("rank", rank).select(
            "lang", "source", F.lit(part).alias("part"), "item", "value", "rank"
        )

    above = shares.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    terms = ranked("term", above).where(F.col("rank") <= top)
    return ranked("pair", _pair_values(groups, shares)).unionByName(terms)


def _pair_values(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of different sources of a language."""
    # Every source meets every other, as the result has them all; both sides are
    # dealt out, so that no task gets a whole language.
    parts = F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1))).alias("part")
    others = groups.select("lang", F.col("source").alias("item"), F.col("z").alias("other_z"), parts)

    def met(rows: DataFrame, *dealt_by: str) -> DataFrame:
        part = F.pmod(F.xxhash64(*dealt_by), F.lit(_PARTS)).cast("int")
        both = rows.withColumn("part", part).join(others, ["lang", "part"])
        return both.where(F.col("source") != F.col("item"))

    apart = met(groups, "source")
    lacking = apart.select("lang", "source", "item", (F.col("kept") * _distance("z", "other_z")).alias("value"))

    # Terms with one share in a source count together.
    once = shares.groupBy("lang", "source", "p", "z").agg(F.count(F.lit(1)).alias("times"))
    alone = met(once, "source", "p")
    alone = alone.select(
        "lang",
        "source",
        "item",
        (F.col("times") * (_distance("p", "other_z") - _distance("z", "other_z"))).alias("value"),
    ).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    path = F.sort_array(F.collect_list(F.struct("source", "p", "z"))).alias("path")
    rows = shares.groupBy("lang", "term").agg(path).where(F.size("path") > 1)
    rows = rows.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times"))
    # Rows that begin alike go to one tree.
    rows = rows.repartition("lang", F.slice("path", 1, 3))
    schema = "lang string, source string, item string, value long"
    both = rows.mapInArrow(_grow_trees, schema)
    both = checkpointed(both.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))

    def turned(values: DataFrame) -> DataFrame:
        return values.select(
            "lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"
        )

    alone = checkpointed(alone)
    given = [lacking, alone, turned(alone), both, turned(both)]
    values = given[0]
    for more in given[1:]:
        values = values.unionByName(more)
    return values.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def oracle_sql() -> str:
    """The same audit in SQL, term by term."""
    p = f"1 + {SCALE}::HUGEINT * (n + {SMOOTHING}) // (total + {SMOOTHING} * kept)"
    return rf"""
        WITH docs AS MATERIALIZED (
          SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                 regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
          FROM documents
        ), spread AS MATERIALIZED (
          SELECT row_number() OVER () AS row, lang, source, terms FROM docs
        ), words AS (SELECT row, lang, source, unnest(terms) AS term FROM spread),
        per_document AS MATERIALIZED (
          SELECT row, lang, source, term, count(*) AS n FROM words GROUP BY ALL
        ), kept_terms AS MATERIALIZED (
          SELECT lang, term FROM per_document
          GROUP BY lang, term HAVING count(*) >= {LEAST_DOCUMENTS}
        ), sizes AS MATERIALIZED (SELECT lang, count(*) AS kept FROM kept_terms GROUP BY lang),
        groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM docs),
        counts AS MATERIALIZED (
          SELECT lang, source, term, sum(n) AS n FROM per_document
          SEMI JOIN kept_terms USING (lang, term) GROUP BY ALL
        ), grid AS MATERIALIZED (
          SELECT lang, source, term, coalesce(n, 0)::HUGEINT AS n, kept,
                 sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total
          FROM groups JOIN kept_terms USING (lang) JOIN sizes USING (lang)
          LEFT JOIN counts USING (lang, source, term)
        ), whole AS (
          SELECT lang, term, sum(n) AS n, any_value(kept) AS kept,
                 sum(sum(n)) OVER (PARTITION BY lang) AS total
          FROM grid GROUP BY lang, term
        ), wholes AS MATERIALIZED (SELECT lang, term, {p} AS q FROM whole),
        shares AS MATERIALIZED (SELECT lang, source, term, n, {p} AS p FROM grid),
        pairs AS (
          SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
          FROM shares a JOIN shares b
            ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
          GROUP BY ALL
        ), found AS (
          SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
          UNION ALL
          SELECT lang, source, 'term', term, p - q FROM shares JOIN wholes USING (lang, term)
          WHERE n > 0 AND p > q
        ), ranked AS (
          SELECT *, row_number() OVER (
            PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
          FROM found
        )
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
        FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
    """
